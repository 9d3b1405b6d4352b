"""Session construction and shared scratch locations.

Library code never creates a session on its own; jobs receive one.  The
helpers here are for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "shroud",
                  shuffle_partitions: int | None = None,
                  listing_parallelism: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A session with AQE on (runtime coalescing, skew-join splitting and
    size-checked broadcast conversion) and a UTC clock."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               # JSON objects with a repeated key keep the last value (instead
               # of failing to parse), as the producing systems' parser does.
               .config("spark.sql.variant.allowDuplicateKeys", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if listing_parallelism:
        # Folder listing runs as a Spark job with one task per folder by
        # default; on one machine, fewer tasks that each list many folders win.
        builder = builder.config("spark.sql.sources.parallelPartitionDiscovery.parallelism",
                                 str(listing_parallelism))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` (or an earlier
    ``setCheckpointDir``).  Only when neither is set, as in unit tests on a
    laptop, a private temporary folder is created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (e.g. Spark Connect)
        sc = None
    if sc is not None:
        base = sc.getCheckpointDir()
        if base:
            # setCheckpointDir appends a per-application uuid folder; share its parent.
            return base.rsplit("/", 1)[0]
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc is not None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="shroud-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/shroud-scratch/{name}-{uuid.uuid4().hex}"


def default_parallelism(spark: SparkSession) -> int:
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:
        return int(spark.conf.get("spark.default.parallelism", None)
                   or spark.conf.get("spark.sql.shuffle.partitions", None) or os.cpu_count() or 8)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete ``path`` recursively on its file system (object store, HDFS,
    local).  Used for scratch tables that must not outlive their job."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).delete(p, True))


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly in a folder that is known to hold few; none where there is no folder."""
    p, fs = _store(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_small(spark: SparkSession, path: str) -> str:
    p, fs = _store(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file and put it in place of ``path`` by one rename, so that a reader finds the old
    content or the new."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    p, fs = _store(spark, path)
    fs.mkdirs(p.getParent())
    new = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(new)
    try:
        out.write(text.encode())
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(new), fs.makeQualified(p), over)
