"""The object store source: key ranges, every name, the sink's totals; purges that spare what is new."""

import os
import random

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from shroud.plans import jobs as J
from shroud.sinks import manifest as MF
from shroud.sinks import objects as KO
from shroud.sources import object_store as O
from shroud.sources import objects as SO


def _local(path):
    return path.replace("file:", "")


def _put(root, names):
    for name in names:
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w") as f:
            f.write(name)


def _names(seed):
    rng = random.Random(seed)
    parts = ["a", "_b", ".c", "d e", "f%2F", "gé", "h+=", "x._COPYING_"]
    out = {"/".join(rng.choice(parts) + str(rng.randrange(9)) for _ in range(rng.choice([1, 2, 5]))) + ".json"
           for _ in range(200)}
    return sorted(out | {f"wide/{i:04}" for i in range(300)} | {"deep/" + "x/" * 20 + "y"})


@pytest.mark.parametrize("splits,probes", [(1, 100), (7, 100), (64, 2000), (500, 2000), (64, 3)])
def test_key_ranges_hold_every_object_once(tmp_path, splits, probes):
    names = _names(splits)
    _put(str(tmp_path), names)
    client, base = fs.LocalFileSystem(), str(tmp_path)
    ranges = O.split_keys(client, base, splits, probes, 50)
    per_range = [[k for k, _ in O.walk(client, base, r)] for r in ranges]
    assert sorted(k for some in per_range for k in some) == names
    if splits >= 64 and probes > 100:  # one wide folder goes to several tasks
        assert sum(any(k.startswith("wide/") for k in some) for some in per_range) > 3


def test_one_wide_and_one_deep_folder_are_split(tmp_path):
    client, base = fs.LocalFileSystem(), str(tmp_path)
    _put(base, [f"a/b/c/{i:04}" for i in range(1000)])
    ranges = O.split_keys(client, base, 16)
    sizes = [sum(1 for _ in O.walk(client, base, r)) for r in ranges]
    assert sum(sizes) == 1000 and max(sizes) <= 1000 // 8


class _Counting:
    """A store that counts how often a folder is listed."""

    def __init__(self, type_name):
        self.type_name, self.inner, self.listed = type_name, fs.LocalFileSystem(), []

    def get_file_info(self, what):
        if isinstance(what, fs.FileSelector):
            self.listed.append(what.base_dir)
        return self.inner.get_file_info(what)


def test_a_folder_is_listed_once_however_many_ranges_it_has(tmp_path):
    base = str(tmp_path)
    _put(base, [f"click/u={i:03}/b" for i in range(400)])
    store = _Counting("remote")
    ranges = O.split_keys(store, base, 32)
    assert len(ranges) >= 32 and len(store.listed) == len(set(store.listed))
    assert ranges == O.split_keys(fs.LocalFileSystem(), base, 32)
    # a task looks at the files of its own names only
    local = _Counting("local")
    assert [k for k, _ in O.walk(local, base, ranges[0])] == [k for k, _ in O.walk(fs.LocalFileSystem(), base, ranges[0])]
    assert f"{base}/click" not in local.listed


def test_a_task_and_the_driver_hold_few_names_of_a_wide_folder(tmp_path, monkeypatch):
    import time
    import tracemalloc

    base = str(tmp_path)
    _put(base, [f"click/u={i:05}/b" for i in range(5000)])
    client, until = fs.LocalFileSystem(), time.time_ns()
    own = O.KeyRange("click", "u=02000", "u=02010")

    def peak(f):
        tracemalloc.start()
        try:
            return f(), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    found, most = peak(lambda: sorted(k for k, _ in O.walk(client, base, own)))
    assert found == [f"click/u={i:05}/b" for i in range(2000, 2010)] and most < 200_000
    monkeypatch.setattr(O, "KNOWN", 300)
    stream = O._StreamReader({"root": base})
    at, most = peak(lambda: stream._newest(until))
    assert most < 300_000 and sum(1 + len(inside) for _, inside in stream.known.values()) <= 300
    assert at == max((os.stat(f"{base}/{k}").st_mtime_ns, k) for k in (f"click/u={i:05}/b" for i in range(5000)))
    # whatever is kept, the newest object is found, also in folders that were quiet
    for name in ("click/u=00000/c", "click/u=04999/c", "click/v/_d"):
        _put(base, [name])
        assert stream._newest(time.time_ns()) == (os.stat(f"{base}/{name}").st_mtime_ns, name)
        os.remove(f"{base}/{name}")


@pytest.mark.parametrize("known", [0, 7, 10_000])
def test_the_newest_object_is_found_whatever_is_kept(tmp_path, monkeypatch, known):
    base, names, day = str(tmp_path), _names(5), 10**18
    _put(base, names + [".x.crc", "deep/.y.crc", "deep/.crc", f"{O.ASIDE}1/z"])
    for folder, _, files in os.walk(base):
        for at in [folder, *(f"{folder}/{f}" for f in files)]:
            os.utime(at, ns=(day, day))
    every = [k for k, _ in O.walk(fs.LocalFileSystem(), base, O.KeyRange(""))]
    assert sorted(every) == sorted(names + ["deep/.crc"])
    monkeypatch.setattr(O, "KNOWN", known)
    rng, stream = random.Random(known), O._StreamReader({"root": base})
    assert stream._newest(2 * day) == (day, max(every))
    for k in range(1, 12):  # an object is written again and its folder tells
        stream.last, name = (day + k - 1, "~"), rng.choice(names)
        for at in (name, os.path.dirname(name)):
            os.utime(f"{base}/{at}", ns=(day + k, day + k))
        assert stream._newest(2 * day) == (day + k, name)
        assert stream._newest(day) == stream.last  # not yet


def test_listing_and_scan_of_every_name(spark, scratch):
    root = scratch("store")
    names = _names(3)
    _put(_local(root), names)
    open(f"{_local(root)}/empty", "w").close()
    listed = SO.list_objects(spark, root)
    assert sorted(r.object_key for r in listed.collect()) == names
    hidden = {r.object_key for r in SO.hidden_objects(spark, root).collect()}
    assert hidden == {n for n in names if O.is_hidden(n)} and 0 < len(hidden) < len(names)
    rows = SO.scan_objects(spark, root).collect()
    assert {(r.object_key, r.payload, r.length) for r in rows} == {(n, n, len(n.encode())) for n in names}
    # the listing is of the same rows as Spark's own for names that it sees
    native = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    seen = listed.join(native, ["path", "length"]).select("object_key")
    assert {r.object_key for r in seen.collect()} == set(names) - hidden
    assert SO.list_objects(spark, f"{root}/none").count() == 0


def test_totals_of_the_sink(spark, scratch):
    one, two = scratch("sink"), scratch("sink")
    df = spark.range(500).select(F.concat(F.lit("k/_"), "id").alias("object_key"),
                                 F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("payload"))
    a = KO.put_totals(df.repartition(5), one)
    b = KO.put_totals(df.repartition(3, "payload"), two)
    assert a == b and a["objects"] == 500 and a["bytes"] == sum(i % 7 for i in range(500))
    # one object swapped for another of equal size
    c = KO.put_totals(df.withColumn("payload", F.when(F.col("object_key") == "k/_8", "y").otherwise(F.col("payload"))), two)
    assert (c["objects"], c["bytes"]) == (a["objects"], a["bytes"]) and c["checksum"] != a["checksum"]
    assert O.found(df.union(spark.createDataFrame([("no", "x")], df.schema)), one).count() == 500


def test_a_failed_write_leaves_nothing_aside(spark, scratch):
    root = scratch("abort")
    df = spark.range(100).select(F.when(F.col("id") < 99, F.concat(F.lit("k"), "id")).alias("object_key"),
                                 F.lit("x").alias("payload"))
    with pytest.raises(Exception, match="not an object key"):
        KO.put_objects(df.repartition(4), root)
    assert not [n for n in os.listdir(_local(root)) if n.startswith(O.ASIDE)]


def test_an_object_that_was_replaced_is_not_purged(spark, scratch):
    base = _local(scratch("replaced"))
    good = '{"results":[{"$properties":{"email":"a@b.c"}}]}'
    os.makedirs(f"{base}/in")
    for name in ("a.json", "_b.json", "c.json", "d.json"):
        with open(f"{base}/in/{name}", "w") as f:
            f.write(good)
    res = J.json_anonymize_job(spark, f"{base}/in", f"{base}/out", f"{base}/q", "source1", ["email"])
    with open(f"{base}/in/a.json", "w") as f:      # another length
        f.write(good.replace("a@b.c", "new@pii.example"))
    os.utime(f"{base}/in/_b.json", (2_000_000_000, 2_000_000_000))  # same length, written later
    os.remove(f"{base}/in/c.json")
    with open(f"{base}/in/late.json", "w") as f:
        f.write(good)
    assert MF.purge(spark, res.manifest, f"{base}/log") == {"deleted": 1, "replaced": 2, "gone": 1}
    assert sorted(n for n in os.listdir(f"{base}/in") if not n.endswith(".crc")) == ["_b.json", "a.json", "late.json"]
    status = {r.path.rsplit("/", 1)[1]: r.status for r in MF.purge_status(spark, f"{base}/log").collect()}
    assert status == {"a.json": "replaced", "_b.json": "replaced", "c.json": "gone", "d.json": "deleted"}


def test_a_purge_that_was_cut_off_is_resumed(spark, scratch, monkeypatch):
    base = _local(scratch("resume"))
    _put(f"{base}/in", [f"k{i}" for i in range(40)])
    m = MF.purge_manifest(spark, f"{base}/in", [""]).collect()
    m = spark.createDataFrame(m)
    whole = MF._deleter

    def cut_off(delete):
        run = whole(delete)

        def some(batches):
            for n, out in enumerate(run(batches)):
                if delete:
                    raise RuntimeError("lost")
                yield out

        return some

    monkeypatch.setattr(MF, "_deleter", cut_off)
    with pytest.raises(Exception, match="lost"):
        MF.purge(spark, m, f"{base}/log")
    monkeypatch.undo()
    assert len(os.listdir(f"{base}/in")) < 40  # some files went, and nothing tells
    assert MF.purge(spark, m, f"{base}/log") == {"deleted": 40, "replaced": 0, "gone": 0}
    assert os.listdir(f"{base}/in") == []
    _put(f"{base}/in", ["k1"])
    assert MF.purge(spark, m, f"{base}/log")["deleted"] == 40  # done: nothing is deleted again
    assert os.listdir(f"{base}/in") == ["k1"]


def test_purge_through_the_file_system_of_the_driver(spark, scratch, monkeypatch):
    base = _local(scratch("hadoop"))
    _put(f"{base}/in", ["a", "b", "c"])
    m = spark.createDataFrame(MF.purge_manifest(spark, f"{base}/in", [""]).collect())
    with open(f"{base}/in/b", "w") as f:
        f.write("longer")
    os.remove(f"{base}/in/c")
    monkeypatch.setattr(MF, "reachable", lambda root: False)
    assert MF.purge(spark, m) == {"deleted": 1, "replaced": 1, "gone": 1}
