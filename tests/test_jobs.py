import os

from shroud import fixtures as fx
from shroud.plans import jobs as J
from shroud.sinks import files as K
from shroud.sinks import manifest as MF
from shroud.sources import objects as SO
from shroud.sources import tables as ST

SF = "/root/testdata/sf0.001"


def test_deidentify_job_gzip_with_staging_manifest(spark, scratch):
    base = scratch("deid")
    K.write_csv(fx.customers(spark, SF), f"{base}/staging/customers", sep=",")
    K.write_csv(fx.deletion_requests(spark, SF), f"{base}/staging/addresses", sep="\t")
    fx.identity_service(spark, SF).write.parquet(f"{base}/idsvc")
    res = J.deidentify_job(spark, ST.read_customers_csv(spark, f"{base}/staging/customers"),
                           spark.read.parquet(f"{base}/idsvc"), public_root=f"{base}/pub",
                           secured_root=f"{base}/sec", audit_root=f"{base}/audit", fmt="gzip",
                           dataset="customers", source="app", as_of="2024-01-01",
                           staging_root=f"{base}/staging", staging_prefixes=["customers"])
    v = res.values
    assert v["public_rows"] + v["missing_identities"] == v["distinct_source_rows"]
    assert v["secured_rows"] == v["distinct_source_rows"]
    folders = {r["folder"] for r in MF.manifest_folders(res.manifest, 1).collect()}
    assert folders == {"customers"}
    # public copy carries no PII
    pub = K.read_by_format(spark, res.outputs["public"], "gzip", __import__("shroud").schemas.DEIDENTIFIED)
    assert pub.where("email is not null or first_name is not null or contact_number is not null").count() == 0


def test_deletion_job_orc_new_version_and_old_versions_listed(spark, scratch):
    base = scratch("del")
    K.write_orc(fx.customers(spark, SF), f"{base}/lake/orc/deleteOverwrite_2023-06-01")
    K.write_tsv_gzip(fx.customers(spark, SF), f"{base}/customers")
    K.write_csv(fx.deletion_requests(spark, SF), f"{base}/requests", sep="\t")
    res = J.deletion_job(spark, ST.read_customers_tsv(spark, f"{base}/customers"),
                         ST.read_deletion_requests(spark, f"{base}/requests/*"),
                         out_root=f"{base}/lake", fmt="orc", as_of="2024-01-01")
    assert res.values["kept_rows"] + res.values["deleted_rows"] == res.values["source_rows"]
    assert res.values["deleted_rows"] > 0
    folders = {r["folder"] for r in MF.manifest_folders(res.manifest, 2).collect()}
    assert folders == {"orc/deleteOverwrite_2023-06-01"}
    # running the deletion again on its own output removes nothing more
    again = J.deletion_job(spark, spark.read.orc(res.outputs["kept"]),
                           ST.read_deletion_requests(spark, f"{base}/requests/*"),
                           out_root=f"{base}/lake2", fmt="orc", as_of="2024-01-02")
    assert again.values["deleted_rows"] == 0
    assert again.values["kept_rows"] == res.values["kept_rows"]


def test_identity_load_twice_is_once(spark, scratch):
    base = scratch("ids")
    K.write_csv(fx.identity_pairs(spark, SF), f"{base}/pairs", sep="\t")
    fx.identity_service(spark, SF).write.parquet(f"{base}/v0")
    pairs = ST.read_identity_pairs(spark, f"{base}/pairs")
    one = J.identity_load_job(spark, pairs, spark.read.parquet(f"{base}/v0"), out_path=f"{base}/v1")
    two = J.identity_load_job(spark, pairs, spark.read.parquet(f"{base}/v1"), out_path=f"{base}/v2")
    assert one.values["new_pairs"] > 0 and two.values["new_pairs"] == 0
    assert two.values["identity_rows_after"] == one.values["identity_rows_after"]


def test_json_job_files_layout(spark, scratch):
    root = scratch("files").replace("file:", "")
    os.makedirs(f"{root}/in/day=1", exist_ok=True)
    with open(f"{root}/in/day=1/a.json", "w") as fh:
        fh.write('{"results":[{"$properties":{"email":"a@b.c","n":1}}]}')
    with open(f"{root}/in/day=1/b.json", "w") as fh:
        fh.write("<html>not json</html>")
    res = J.json_anonymize_job(spark, f"{root}/in", f"{root}/out", f"{root}/q", "source1",
                               "email,phone")
    assert res.values == {"listed_objects": 2, "redacted_objects": 1, "quarantined_objects": 1,
                          "written_objects": 1}
    out = SO.scan_objects(spark, f"{root}/out").collect()
    assert [r["object_key"] for r in out] == ["anonymized/day=1/a.json"]
    assert '"email":""' in out[0]["payload"] and '"phone":""' in out[0]["payload"]


def test_incomplete_identity_snapshot_fails_bounded(spark, scratch):
    import pytest

    base = scratch("incomplete")
    fx.identity_service(spark, SF).write.parquet(f"{base}/idsvc")
    reads = []

    def reader():
        reads.append(1)
        return spark.read.parquet(f"{base}/idsvc")

    n = spark.read.parquet(f"{base}/idsvc").count()
    assert J.wait_for_complete_lookup(reader, n).count() == n
    with pytest.raises(J.VerificationError):
        J.wait_for_complete_lookup(reader, n + 1, attempts=2, wait_seconds=0)
    assert len(reads) == 3


def test_deletion_job_everything_deleted_gzip(spark, scratch):
    from pyspark.sql import functions as F

    base = scratch("del-all")
    src = fx.customers(spark, SF).where(F.col("email").isNotNull())
    K.write_tsv_gzip(src, f"{base}/customers")
    K.write_csv(src.select(F.upper(F.trim("email")).alias("email")), f"{base}/requests", sep="\t")
    res = J.deletion_job(spark, ST.read_customers_tsv(spark, f"{base}/customers"),
                         ST.read_deletion_requests(spark, f"{base}/requests/*"),
                         out_root=f"{base}/lake", fmt="gzip", as_of="2024-01-01", strict=True)
    assert res.values["kept_rows"] == 0
    assert res.values["deleted_rows"] == res.values["source_rows"]


def test_deidentify_job_outputs_equal_standalone_operators(spark, scratch):
    from shroud import schemas
    from shroud.operators import audit, identity

    base = scratch("deid-eq")
    cust = fx.customers(spark, SF)
    idsvc = fx.identity_service(spark, SF)
    res = J.deidentify_job(spark, cust, idsvc, public_root=f"{base}/pub",
                           secured_root=f"{base}/sec", audit_root=f"{base}/audit", fmt="orc",
                           dataset="c", source="app", as_of="2024-01-01")

    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)

    assert rows(spark.read.schema(schemas.DEIDENTIFIED).orc(res.outputs["public"])) == \
        rows(identity.deidentify(cust, idsvc, "app", "2024-01-01"))
    assert rows(spark.read.schema(schemas.SECURED).orc(res.outputs["secured"])) == \
        rows(identity.secure(cust, idsvc, "app", "2024-01-01"))
    got_audit = audit.read_audit(spark, f"{base}/audit")
    assert rows(got_audit) == rows(identity.missing_identities(cust, idsvc, "app", "2024-01-01"))


def test_null_uuid_counts_as_matched(spark):
    from shroud import schemas
    from shroud.operators import identity

    cust = spark.createDataFrame([tuple(["1", "a"] + [None] * 16), tuple(["2", "b"] + [None] * 16)],
                                 schemas.CUSTOMERS)
    idsvc = spark.createDataFrame([("app-1", None)], schemas.IDENTITY)
    j = identity.join_identities(cust, idsvc, "app")
    pub = identity.deidentified_from(j).collect()
    miss = identity.missing_from(j, "app").collect()
    assert [(r["id"], r["gid"]) for r in pub] == [("1", None)]
    assert [r["source_id"] for r in miss] == ["app-2"]
    # same as the standalone operators
    assert [(r["id"], r["gid"]) for r in identity.deidentify(cust, idsvc, "app").collect()] == [("1", None)]
    assert [r["source_id"] for r in identity.missing_identities(cust, idsvc, "app").collect()] == ["app-2"]


def test_identity_load_append_equals_upsert(spark, scratch):
    from shroud.operators import identity

    base = scratch("ids-append")
    fx.identity_service(spark, SF).write.parquet(f"{base}/table")
    pairs = fx.identity_pairs(spark, SF)
    before = spark.read.parquet(f"{base}/table")
    expected = sorted(map(tuple, identity.upsert_identities(
        before, identity.new_identity_pairs(pairs, before)).collect()), key=str)
    res = J.identity_load_job(spark, pairs, spark.read.parquet(f"{base}/table"),
                              append_to=f"{base}/table")
    got = sorted(map(tuple, spark.read.parquet(f"{base}/table").collect()), key=str)
    assert got == expected
    assert res.values["appended_rows"] == res.values["identity_rows_after"] - res.values["lookup_rows"]
    again = J.identity_load_job(spark, pairs, spark.read.parquet(f"{base}/table"),
                                append_to=f"{base}/table")
    assert again.values["appended_rows"] == 0


def test_json_runs_accumulate_and_never_purge_quarantined(spark, scratch):
    import json as _json

    from shroud.sources import objects as SO

    root = scratch("accumulate").replace("file:", "")
    good = '{"results":[{"$properties":{"email":"a@b.c"}}]}'

    def put(run, name, text):
        os.makedirs(f"{root}/{run}", exist_ok=True)
        with open(f"{root}/{run}/{name}", "w") as fh:
            fh.write(text)

    put("in1", "a.json", good)
    put("in1", "k.json", good)
    r1 = J.json_anonymize_job(spark, f"{root}/in1", f"{root}/out", f"{root}/q", "source1", ["email"])
    assert r1.values["written_objects"] == 2
    put("in2", "b.json", good)
    put("in2", "k.json", "{broken")           # a new, unreadable version of k.json
    r2 = J.json_anonymize_job(spark, f"{root}/in2", f"{root}/out", f"{root}/q", "source1", ["email"])
    assert r2.values == {"listed_objects": 2, "redacted_objects": 1, "quarantined_objects": 1,
                         "written_objects": 1}
    keys = sorted(r["object_key"] for r in SO.list_objects(spark, f"{root}/out").collect())
    assert keys == ["anonymized/a.json", "anonymized/b.json", "anonymized/k.json"]  # run 1 kept
    assert [r["object_key"] for r in r2.manifest.collect()] == ["b.json"]       # k.json held
    q = spark.read.parquet(f"{root}/q").collect()
    assert [(r["object_key"], r["reason"]) for r in q] == [("k.json", "unparseable_json")]


def test_deidentify_job_leaves_no_pii_scratch(spark, scratch):
    import glob as _glob

    from shroud.session import ensure_checkpoint_dir

    base = scratch("deid-clean")
    root = ensure_checkpoint_dir(spark).replace("file:", "")
    before = set(_glob.glob(f"{root}/shroud-scratch/deidentify-cleanme-*"))
    J.deidentify_job(spark, fx.customers(spark, SF), fx.identity_service(spark, SF),
                     public_root=f"{base}/pub", secured_root=f"{base}/sec",
                     audit_root=f"{base}/audit", fmt="orc", dataset="cleanme", source="app")
    assert set(_glob.glob(f"{root}/shroud-scratch/deidentify-cleanme-*")) == before


def test_json_job_on_empty_prefix(spark, scratch):
    root = scratch("empty-prefix").replace("file:", "")
    os.makedirs(f"{root}/in", exist_ok=True)
    res = J.json_anonymize_job(spark, f"{root}/in", f"{root}/out", f"{root}/q", "source2", ["name"])
    assert res.values == {"listed_objects": 0, "redacted_objects": 0, "quarantined_objects": 0,
                          "written_objects": 0}
    assert res.manifest.count() == 0
