"""Delimited-text scans with fixed schemas (no inference, case-sensitive names).

Paths may be files, folders or globs; gzip/snappy files are decoded by the
file source.  All scans are plain file sources, so Spark splits them into
``spark.sql.files.maxPartitionBytes`` chunks (gzip files: one task each) and
prunes columns before any later operator sees them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas

_QUOTED = {"quote": '"', "escape": '"'}


def _read(spark: SparkSession, path: str | list[str], schema, sep: str, multiline: bool,
          null_value: str | None) -> DataFrame:
    r = spark.read.schema(schema).option("sep", sep).options(**_QUOTED)
    if multiline:
        r = r.option("multiLine", True)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    return r.csv(path)


def read_customers_csv(spark: SparkSession, path, multiline: bool = False,
                       null_value: str | None = None) -> DataFrame:
    """Customer export, comma separated, no header, ``"`` doubled inside quotes."""
    return _read(spark, path, schemas.CUSTOMERS, ",", multiline, null_value)


def read_customers_tsv(spark: SparkSession, path, multiline: bool = False,
                       null_value: str | None = None) -> DataFrame:
    """Customer export, tab separated (the format the de-identify job writes)."""
    return _read(spark, path, schemas.CUSTOMERS, "\t", multiline, null_value)


def read_deletion_requests(spark: SparkSession, path) -> DataFrame:
    """Deletion requests, one e-mail per line; ``path`` is usually a glob ``dir/*``."""
    return _read(spark, path, schemas.DELETIONS, "\t", False, None)


def read_identity_pairs(spark: SparkSession, path, sep: str = "\t") -> DataFrame:
    """Identity pairs (sourceSystemId, uuid) as exported; duplicates are kept."""
    return _read(spark, path, schemas.IDENTITY, sep, False, None)
