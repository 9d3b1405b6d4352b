"""Audit table of customers without an identity, refreshed per source.

A refresh is published in two phases.  The rows of the source are written to a new folder first;
then one small pointer file, ``_current/<source>``, is swapped for one that names that folder.
Readers follow the pointers, so they see the old rows or the new ones, never a part: a run that
fails before the swap changes nothing, and one that fails after it leaves only an old folder behind.
Folders of the source that no pointer names are removed by the next refresh; a source has one writer at
a time.  Other sources' rows are untouched, and an empty refresh clears the stale rows of its source, as
a delete-then-insert would.

Tables of the former layout (folders ``source=<name>`` and no pointers) are read as they are; the
first refresh of a source replaces its folder there.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import AUDIT, AUDIT_COLUMNS
from ..session import list_names, path_exists, read_small, remove_path, replace_small

POINTERS = "_current"


def _name(source: str) -> str:
    return quote(source, safe="") or "%00"


def _swap(spark: SparkSession, root: str, source: str, folder: str) -> None:
    """Phase two: one file is replaced by a rename."""
    replace_small(spark, f"{root}/{POINTERS}/{_name(source)}", json.dumps({"source": source, "folder": folder}))


def _pointers(spark: SparkSession, root: str) -> list[dict]:
    """A pointer a source; names of a source are few."""
    at = f"{root}/{POINTERS}"
    return [json.loads(read_small(spark, f"{at}/{n}")) for n in list_names(spark, at) if not n.startswith(".")]


def refresh_audit(audit_rows: DataFrame, table_root: str, source: str,
                  fmt: str = "parquet") -> None:
    spark, root = audit_rows.sparkSession, table_root.rstrip("/")
    folder = f"{_name(source)}/{uuid.uuid4().hex}"
    rows = audit_rows.where(F.col("source") == source).select(*AUDIT_COLUMNS)
    rows.write.mode("overwrite").format(fmt).save(f"{root}/data/{folder}")
    _swap(spark, root, source, folder)
    for old in list_names(spark, f"{root}/data/{_name(source)}"):
        if old != folder.split("/")[1]:
            remove_path(spark, f"{root}/data/{_name(source)}/{old}")
    if path_exists(spark, f"{root}/source={source}"):  # of the former layout
        remove_path(spark, f"{root}/source={source}")


def read_audit(spark: SparkSession, table_root: str, fmt: str = "parquet") -> DataFrame:
    root = table_root.rstrip("/")
    known = _pointers(spark, root)
    out = None
    if known:
        out = spark.read.schema(AUDIT).format(fmt).load([f"{root}/data/{p['folder']}" for p in known])
    former = [n for n in list_names(spark, root) if n.startswith("source=")]
    if former or out is None:
        if not former and path_exists(spark, root):
            old = spark.createDataFrame([], AUDIT)
        else:
            old = (spark.read.schema(AUDIT).option("basePath", root).format(fmt)
                   .load([f"{root}/{n}" for n in former] or root))
        named = [p["source"] for p in known]
        old = old.where(~F.col("source").isin(named)) if named else old
        out = old if out is None else out.unionByName(old.select(*out.columns))
    return out.select(*AUDIT_COLUMNS)


def append_audit_jdbc(audit_rows: DataFrame, url: str, table: str, properties: dict,
                      num_partitions: int | None = None, batch_size: int = 5000) -> None:
    """Append audit rows to a relational table in parallel batched inserts.

    Clearing the source's old rows is the table owner's statement (or use
    the table above, whose refresh replaces one source)."""
    df = audit_rows.repartition(num_partitions) if num_partitions else audit_rows
    props = dict(properties)
    props.setdefault("batchsize", str(batch_size))
    df.write.mode("append").jdbc(url, table, properties=props)
