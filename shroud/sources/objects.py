"""Whole-object scans under a prefix (one JSON document per stored object).

Where tasks can reach the store, ``object_store`` lists and reads objects of any name in key
ranges.  Else, and for the keyed layout, Spark's own file sources do:

``scan_objects`` reads every file below ``root`` as one row with the text
file source (``wholetext``); ``.gz`` objects are decompressed by the source
itself, and for gzip sources objects named without ``.gz`` are gunzipped
too (``gzip_any_name``).  Zero-length objects are skipped by the file listing (they are
neither scanned nor listed, as they carry no document).  A corrupt object (e.g. a
truncated gzip stream) is skipped by the reader instead of failing the job,
and ``unread_objects`` recovers it from the metadata-only listing so that it
is quarantined, never lost.

Two key layouts are understood:

* ``files``: any layout; the key is the path relative to ``root``.
* ``keyed``: objects published by Spark with ``partitionBy("object_key")``
  (see ``shroud.sinks.objects``); the key is the decoded partition value.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import gunzip_text
from ..functions.store import reachable
from .object_store import reader_of

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*:)?/*"
# File names with the gzip suffix, and every other file name (Hadoop glob).
GZ_NAMES = "*.gz"
NOT_GZ_NAMES = "{*[!z],*[!g]z,*[!.]gz,z,gz}"


def _norm_root(root: str) -> str:
    return re.sub(_SCHEME, "", root).rstrip("/")


def decode_uri(col: Column) -> Column:
    """Percent-decoding that leaves '+' alone (paths are not form data)."""
    return F.url_decode(F.replace(col, F.lit("+"), F.lit("%2B")))


def relative_path(path: Column, root: str) -> Column:
    base = re.escape(_norm_root(root))
    return F.regexp_extract(F.regexp_replace(path, _SCHEME, ""), f"^{base}/(.*)$", 1)


def object_key(path: Column, root: str, layout: str = "files") -> Column:
    rel = relative_path(path, root)
    if layout == "files":
        return rel
    if layout == "keyed":
        return decode_uri(F.regexp_extract(rel, r"^object_key=([^/]*)/", 1))
    raise ValueError(f"unknown object layout {layout!r}")


class HiddenNamesError(RuntimeError):
    """Objects that Spark's file sources pass over because of their names."""


def hidden_names(spark: SparkSession, root: str, most: int = 20) -> list[str]:
    """Non-empty objects below ``root`` that Spark's file sources do not see: a
    file or folder name begins with ``_`` or ``.``, or ends in ``._COPYING_``.

    Found level by level with file-system globs, which do list such names.
    """
    sc = spark.sparkContext
    path_type = sc._jvm.org.apache.hadoop.fs.Path
    fs = path_type(root).getFileSystem(sc._jsc.hadoopConfiguration())
    found: list[str] = []
    level = root.rstrip("/")
    while len(found) < most:
        for pattern in ("[_.]*", "*._COPYING_"):
            for status in fs.globStatus(path_type(f"{level}/{pattern}")) or []:
                size = fs.getContentSummary(status.getPath()).getLength()
                if size > 0 and len(found) < most:  # empty markers such as _SUCCESS hold nothing
                    found.append(status.getPath().toString())
        level += "/*"
        if not len(fs.globStatus(path_type(level)) or []):
            break
    return found


def require_visible_names(spark: SparkSession, root: str) -> None:
    """Fail before anything is processed if some objects would be passed over."""
    found = hidden_names(spark, root)
    if found:
        raise HiddenNamesError(
            "Spark's file sources skip names that begin with _ or . or end in ._COPYING_; "
            f"rename or move these objects first: {', '.join(found)}")


def hidden_objects(spark: SparkSession, root: str) -> DataFrame:
    """(object_key, path, length, modificationTime) of the non-empty objects below
    ``root`` that Spark's file sources pass over because of a name."""
    return reader_of(spark, root, content=False, names="hidden").load().drop("content")


def scan_objects(spark: SparkSession, root: str, layout: str = "files",
                 gzip_any_name: bool = False) -> DataFrame:
    """(object_key, path, payload) for every readable, non-empty object.

    ``gzip_any_name``: the source compresses every object, whatever its
    name.  ``*.gz`` files are decoded by the text source as usual; the other
    names (disjoint glob, so nothing is read twice) are read as bytes and
    gunzipped.  Their payload is NULL when the bytes are not gzip, so the
    object is quarantined rather than dropped.

    In the ``files`` layout, where tasks can reach the store, objects of every name are read
    (``object_store``), with ``length`` and ``modificationTime`` of what was read; there the payload of
    any object that cannot be decoded is NULL.  Else Spark's file sources read, which pass over
    hidden names.
    """
    if layout == "files" and reachable(root):
        stored = reader_of(spark, root, decode="gzip" if gzip_any_name else "suffix").load()
        return stored.select("object_key", "path", F.col("content").cast("string").alias("payload"),
                             "length", "modificationTime")
    reader = (spark.read.format("text")
              .option("wholetext", True)
              .option("recursiveFileLookup", True)
              .option("ignoreCorruptFiles", True))
    if gzip_any_name:
        reader = reader.option("pathGlobFilter", GZ_NAMES)
    raw = reader.load(root)
    path = decode_uri(F.col("_metadata.file_path"))
    docs = (raw.select(path.alias("path"), F.col("value").alias("payload"))
            .where(F.length("payload") > 0))
    if gzip_any_name:
        other = (spark.read.format("binaryFile")
                 .option("recursiveFileLookup", True)
                 .option("pathGlobFilter", NOT_GZ_NAMES)
                 .load(root)
                 # binaryFile's path is already in the form list_objects uses
                 .select(F.col("path"), gunzip_text("content").alias("payload")))
        docs = docs.unionByName(other)
    return docs.select(object_key(F.col("path"), root, layout).alias("object_key"),
                       "path", "payload")


def list_objects(spark: SparkSession, root: str, layout: str = "files") -> DataFrame:
    """(object_key, path, length, modificationTime) of every non-empty object; content is not read.

    Of every name in the ``files`` layout where tasks reach the store, else of visible ones."""
    if layout == "files" and reachable(root):
        return reader_of(spark, root, content=False).load().drop("content")
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", True)
             .load(root)
             .select("path", "length", "modificationTime"))
    return files.select(object_key(F.col("path"), root, layout).alias("object_key"), "path",
                        "length", "modificationTime")


def unread_objects(listing: DataFrame, scanned: DataFrame) -> DataFrame:
    """Listed objects that produced no row (unreadable, or text that is empty).

    Only the paths of the scanned side take part in the anti-join, so no
    payload is shuffled."""
    gone = listing.join(scanned.select("path"), "path", "left_anti")
    return gone.select("object_key", "path", "length",
                       F.when(F.col("length") == 0, "empty_object")
                       .otherwise("unreadable_object").alias("reason"))
