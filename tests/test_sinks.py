import gzip
import glob

from pyspark.sql import functions as F

from shroud import schemas
from shroud.operators import audit
from shroud.sinks import files, manifest
from shroud.sources import tables


def _customers(spark, rows):
    return spark.createDataFrame([tuple(list(r) + [None] * (18 - len(r))) for r in rows],
                                 schemas.CUSTOMERS)


def test_tsv_quotes_whitespace_and_empty(spark, scratch):
    p = scratch("tsv")
    df = _customers(spark, [("1", ' a"b ', "", None, "t\tab")])
    files.write_tsv_gzip(df, p)
    raw = b"".join(gzip.open(f).read() for f in glob.glob(p.replace("file:", "") + "/part-*.gz"))
    assert raw.startswith(b'"1"\t" a""b "\t""\t""\t"t\tab"')
    r = tables.read_customers_tsv(spark, p).first()
    # whitespace and quotes survive; '' and NULL both read back as NULL
    assert (r["id"], r["email"], r["created_at"], r["updated_at"], r["first_name"]) == \
        ("1", ' a"b ', None, None, "t\tab")


def test_orc_keeps_empty_string(spark, scratch):
    p = scratch("orc")
    df = _customers(spark, [("1", "", None)])
    files.write_orc(df, p)
    r = spark.read.schema(schemas.CUSTOMERS).orc(p).first()
    assert r["email"] == "" and r["created_at"] is None


def test_audit_refresh_replaces_one_source_and_empty_clears(spark, scratch):
    root = scratch("audit")
    mk = lambda src, n: spark.createDataFrame(
        [(src, f"{src}-{i}", None, None, "d") for i in range(n)], schemas.AUDIT)
    audit.refresh_audit(mk("a", 3), root, "a")
    audit.refresh_audit(mk("b", 2), root, "b")
    audit.refresh_audit(mk("a", 1), root, "a")
    got = sorted((r["source"], r["source_id"]) for r in audit.read_audit(spark, root).collect())
    assert got == [("a", "a-0"), ("b", "b-0"), ("b", "b-1")]
    audit.refresh_audit(mk("a", 0), root, "a")
    got = sorted(r["source"] for r in audit.read_audit(spark, root).collect())
    assert got == ["b", "b"]


def test_manifests_and_apply(spark, scratch):
    root = scratch("lake")
    df = _customers(spark, [("1",), ("2",)])
    files.write_orc(df, f"{root}/orc/deleteOverwrite_2023-01-01")
    files.write_orc(df, f"{root}/orc/deleteOverwrite_2024-01-01")
    files.write_orc(df, f"{root}/other")
    m = manifest.purge_manifest_keep_version(spark, root, "orc", "deleteOverwrite_2024-01-01")
    folders = manifest.manifest_folders(m, 2)
    assert [r["folder"] for r in folders.collect()] == ["orc/deleteOverwrite_2023-01-01"]
    n = m.count()
    assert n > 0 and manifest.apply_purge(spark, m) == n
    left = manifest.purge_manifest(spark, root, ["orc", "other"])
    assert {r["relative_path"].split("/")[1] for r in left.collect() if r["relative_path"].startswith("orc")} \
        == {"deleteOverwrite_2024-01-01"}


def test_keyvalue_put_partitions(spark, scratch):
    import json
    import os
    import uuid

    from shroud.sinks.keyvalue import put_partitions

    store = scratch("kv").replace("file:", "")
    os.makedirs(store, exist_ok=True)

    def put_batch(rows):
        assert len(rows) <= 7
        with open(os.path.join(store, uuid.uuid4().hex), "w") as fh:
            json.dump(rows, fh)

    df = spark.createDataFrame([(f"app-{i}", f"g{i}") for i in range(50)],
                               schemas.IDENTITY)
    put_partitions(df, put_batch, batch_size=7, num_partitions=3)
    got = {}
    for f in os.listdir(store):
        for r in json.load(open(os.path.join(store, f))):
            got[r["sourceSystemId"]] = r["uuid"]
    assert got == {f"app-{i}": f"g{i}" for i in range(50)}


def test_manifest_empty_prefix_means_everything(spark, scratch):
    root = scratch("lake-all")
    df = _customers(spark, [("1",)])
    files.write_orc(df, f"{root}/a")
    files.write_orc(df, f"{root}/b/c")
    every = {r["relative_path"].split("/")[0] for r in manifest.purge_manifest(spark, root, [""]).collect()}
    assert every == {"a", "b"}
    assert manifest.purge_manifest(spark, root, []).count() == 0
