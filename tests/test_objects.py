import glob
import json
import os

from pyspark.sql import functions as F

from shroud.plans import jobs as J
from shroud.sinks import objects as KO
from shroud.sources import objects as SO


def _docs(spark, n, prefix="k"):
    rows = [(f"{prefix}/a+b%{i}=x.json", json.dumps({"yepchat": [{"payload": {"conversations": [
        {"guest": {"name": "G"}, "messages": [{"body": f"call 415-555-{1000 + i:04d}"}]}]}}]}))
        for i in range(n)]
    return spark.createDataFrame(rows, "object_key string, payload string")


def test_keyed_publish_and_scan_roundtrip(spark, scratch):
    root = scratch("objs")
    KO.write_objects(_docs(spark, 5), root, gzip=True)
    got = SO.scan_objects(spark, root, layout="keyed").orderBy("object_key").collect()
    assert [r["object_key"] for r in got] == sorted(f"k/a+b%{i}=x.json" for i in range(5))
    assert all(json.loads(r["payload"])["yepchat"] for r in got)


def test_truncated_gzip_is_quarantined_not_lost(spark, scratch):
    base = scratch("trunc")
    KO.write_objects(_docs(spark, 6), f"{base}/in", gzip=True)
    victim = sorted(glob.glob(f"{base.replace('file:', '')}/in/**/*.gz", recursive=True))[0]
    data = open(victim, "rb").read()
    with open(victim, "wb") as fh:
        fh.write(data[: len(data) // 2])
    res = J.json_anonymize_job(spark, f"{base}/in", f"{base}/out", f"{base}/q", "source2",
                               ["name"], layout="keyed")
    assert res.values["listed_objects"] == 6
    assert res.values["redacted_objects"] == 5
    assert res.values["quarantined_objects"] == 1
    q = spark.read.parquet(f"{base}/q").collect()
    assert [r["reason"] for r in q] == ["unreadable_object"]
    out = SO.scan_objects(spark, f"{base}/out", gzip_any_name=True).collect()
    assert all(r["object_key"].startswith("anonymized/k/") for r in out)
    # the unreadable object is not offered for purging
    purge = {r["object_key"] for r in res.manifest.collect()}
    assert len(purge) == 5 and purge == {r["object_key"][len("anonymized/"):] for r in out}
    assert all("(Anonymized PII)" in r["payload"] for r in out)


def test_files_layout_relative_keys(spark, scratch):
    root = scratch("plain").replace("file:", "")
    os.makedirs(f"{root}/chat/day=1", exist_ok=True)
    with open(f"{root}/chat/day=1/a.json", "w") as fh:
        fh.write('{"results":[]}')
    open(f"{root}/chat/empty.json", "w").close()
    scanned = SO.scan_objects(spark, root)
    assert [r["object_key"] for r in scanned.collect()] == ["chat/day=1/a.json"]
    # zero-length objects are skipped by the file listing itself (never processed)
    listed = [r["object_key"] for r in SO.list_objects(spark, root).collect()]
    assert listed == ["chat/day=1/a.json"]
    assert SO.unread_objects(SO.list_objects(spark, root), scanned).count() == 0


def test_gzip_objects_without_suffix(spark, scratch):
    import gzip as _gzip

    root = scratch("gz-any").replace("file:", "")
    os.makedirs(f"{root}/in/a", exist_ok=True)
    doc = {"yepchat": [{"payload": {"conversations": [
        {"guest": {"name": "G"}, "messages": [{"body": "call 415-555-1234"}]}]}}]}
    with _gzip.open(f"{root}/in/a/no-suffix", "wb") as fh:          # gzip, no .gz name
        fh.write(json.dumps(doc).encode())
    with _gzip.open(f"{root}/in/a/with.json.gz", "wb") as fh:       # gzip, .gz name
        fh.write(json.dumps(doc).encode())
    with open(f"{root}/in/a/plain.json", "w") as fh:                # not gzip at all
        fh.write(json.dumps(doc))
    scanned = {r["object_key"]: r["payload"] for r in
               SO.scan_objects(spark, f"{root}/in", gzip_any_name=True).collect()}
    assert set(scanned) == {"a/no-suffix", "a/with.json.gz", "a/plain.json"}
    assert json.loads(scanned["a/no-suffix"]) == doc == json.loads(scanned["a/with.json.gz"])
    assert scanned["a/plain.json"] is None
    res = J.json_anonymize_job(spark, f"{root}/in", f"{root}/out", f"{root}/q", "source2", ["name"])
    assert res.values["redacted_objects"] == 2 and res.values["quarantined_objects"] == 1
    assert {r["object_key"] for r in res.manifest.collect()} == {"a/no-suffix", "a/with.json.gz"}
