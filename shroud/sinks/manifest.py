"""Purge manifests: what may be deleted once replacement data is verified.

Only file metadata is read.  Removal is a separate, explicit step, done by tasks and only for
files that are still what the manifest lists.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.store import place, reachable
from ..session import path_exists, scratch_path
from ..sources.objects import list_objects, relative_path


def purge_manifest(spark: SparkSession, root: str, prefixes: list[str]) -> DataFrame:
    """Every file under ``root`` whose relative path starts with one of ``prefixes``."""
    files = list_objects(spark, root)
    rel = relative_path(F.col("path"), root)
    cond = None
    for p in prefixes:
        p = p.strip("/")
        # an empty prefix means everything under root
        c = F.lit(True) if not p else rel.startswith(p + "/")
        cond = c if cond is None else cond | c
    if cond is None:
        cond = F.lit(False)
    return files.where(cond).select(rel.alias("relative_path"), "path", "length",
                                    "modificationTime")


def purge_manifest_keep_version(spark: SparkSession, root: str, prefix: str,
                                marker: str) -> DataFrame:
    """Files under ``prefix`` whose path does not contain the new-version ``marker``."""
    m = purge_manifest(spark, root, [prefix])
    return m.where(~F.col("path").contains(marker))


def manifest_folders(manifest: DataFrame, depth: int) -> DataFrame:
    """Distinct folders (first ``depth`` path elements) covered by a manifest, with totals."""
    folder = F.array_join(F.slice(F.split("relative_path", "/"), 1, depth), "/")
    return manifest.groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


STATUS = "path string, status string"


def _deleter(delete: bool) -> Callable:
    """Task function: what is stored at each path, against its length and time in the manifest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clients: dict = {}
        for b in batches:
            paths, status = b.column(0).to_pylist(), []
            for path, length, at in zip(paths, b.column(1).to_pylist(), b.column(2).to_pylist()):
                client, at_store = place(path, clients)
                info = client.get_file_info(at_store)
                if not info.is_file:
                    status.append("deleted" if delete else "gone")
                elif not _same(info, length, at):
                    status.append("replaced")
                else:
                    if delete:
                        client.delete_file(at_store)
                    status.append("deleted" if delete else "due")
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(status, pa.string())], names=["path", "status"])

    return run


def _same(info: pafs.FileInfo, length: int | None, millis: int | None) -> bool:
    """Whether the object is the one of the manifest; times agree to what the coarser side tells."""
    if length is not None and info.size != length:
        return False
    now = (info.mtime_ns or 0) // 1_000_000
    return millis is None or now == millis or (millis % 1000 == 0 or now % 1000 == 0) and now // 1000 == millis // 1000


def _delete_here(spark: SparkSession, rows: DataFrame, delete: bool) -> DataFrame:
    """As ``_deleter`` for stores that only Hadoop's client reaches: rows stream through the driver."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def one(r) -> tuple[str, str]:
        path = jvm.org.apache.hadoop.fs.Path(r["path"])
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            return r["path"], "deleted" if delete else "gone"
        found = fs.getFileStatus(path)
        info = pafs.FileInfo(r["path"], pafs.FileType.File, size=found.getLen(),
                             mtime_ns=found.getModificationTime() * 1_000_000)
        if not _same(info, r["length"], r["at"]):
            return r["path"], "replaced"
        if delete:
            fs.delete(path, False)
        return r["path"], "deleted" if delete else "due"

    out = None
    with ThreadPoolExecutor(16) as pool:
        paths = rows.toLocalIterator()
        while some := list(islice(paths, 10_000)):
            at = scratch_path(spark, "purge-part")
            spark.createDataFrame(list(pool.map(one, some)), STATUS).write.parquet(at)
            out = spark.read.parquet(at) if out is None else out.unionByName(spark.read.parquet(at))
    return spark.createDataFrame([], STATUS) if out is None else out


def purge(spark: SparkSession, manifest: DataFrame, log_root: str | None = None) -> dict[str, int]:
    """Delete the manifest's files that are still what the manifest says; the number of each status.

    ``deleted``: gone by this purge.  ``replaced``: another length or modification time, so not what was
    read; it stays.  ``gone``: not there when the purge began.  A manifest without ``length`` or
    ``modificationTime`` deletes by path and what it has.  Folders and files that the manifest does not name stay.

    The purge has two steps, both in tasks.  ``log_root/due`` first tells which files will be deleted;
    then they are, each looked at again, and ``log_root/done`` tells what became of them.  A purge that was cut
    off is resumed by calling again with the same ``log_root``: files that are due and not there
    any more count as deleted.  A purge that is done returns its counts and deletes nothing.
    """
    log_root = log_root or scratch_path(spark, "purge")
    due, done = f"{log_root}/due", f"{log_root}/done"

    def written(path: str) -> bool:
        return path_exists(spark, f"{path}/_SUCCESS")

    def look(rows: DataFrame, delete: bool) -> DataFrame:
        rows = rows.select("path", "length", F.unix_millis("modificationTime").alias("at"))
        first = rows.select("path").head()
        if first is None or reachable(first[0]):
            return rows.mapInArrow(_deleter(delete), STATUS)
        return _delete_here(spark, rows, delete)

    if not written(due):
        columns = [F.col(c) if c in manifest.columns else F.lit(None).cast(t).alias(c)
                   for c, t in (("path", "string"), ("length", "long"), ("modificationTime", "timestamp"))]
        listed = scratch_path(spark, "purge-listed")  # the manifest may be a listing of the files that go
        # a path of several rows was listed at several times: the newest is what was read last
        (manifest.select(*columns).groupBy("path").agg(F.max(F.struct("modificationTime", "length")).alias("r"))
         .select("path", "r.length", "r.modificationTime").write.parquet(listed))
        rows = spark.read.parquet(listed)
        (look(rows, False).join(rows, "path").write.mode("overwrite").parquet(due))
    plan = spark.read.parquet(due)
    if not written(done):
        rest = plan.where("status <> 'due'").select("path", "status")
        look(plan.where("status = 'due'"), True).unionByName(rest).write.mode("overwrite").parquet(done)
    counts = {"deleted": 0, "replaced": 0, "gone": 0}
    counts.update((r.status, r["count"]) for r in spark.read.parquet(done).groupBy("status").count().collect())
    return counts


def purge_status(spark: SparkSession, log_root: str) -> DataFrame:
    """(path, status) of every file of a purge that is done."""
    return spark.read.schema(STATUS).parquet(f"{log_root}/done")


def apply_purge(spark: SparkSession, manifest: DataFrame, log_root: str | None = None) -> int:
    """``purge``; the number of files deleted."""
    return purge(spark, manifest, log_root)["deleted"]
