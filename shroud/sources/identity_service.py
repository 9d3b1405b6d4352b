"""Identity-service reads.

The service is read as a partitioned table: a columnar snapshot (parquet /
ORC) or a JDBC table split into ``num_partitions`` range reads.  Executors
read their own slices; nothing is gathered on the driver.

An indexed snapshot (``write_identity_index``) holds the normalised keys in order, with a Bloom filter
of the keys in every row group, so that a batch of few keys reads only the row groups that can hold one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def read_identity_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path).select(*schemas.IDENTITY_COLUMNS)


def read_identity_jdbc(spark: SparkSession, url: str, table: str, properties: dict,
                       partition_column: str, lower: int, upper: int,
                       num_partitions: int) -> DataFrame:
    """Parallel JDBC read; ``partition_column`` is a numeric column of the table."""
    return (spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                            upperBound=upper, numPartitions=num_partitions,
                            properties=properties)
            .select(*schemas.IDENTITY_COLUMNS))


def lookup(idsvc: DataFrame, key: str) -> DataFrame:
    """Point lookup of one key; the filter reaches the scan as a pushed predicate."""
    return idsvc.where(F.col("sourceSystemId") == key).select("uuid")


def row_count(idsvc: DataFrame) -> DataFrame:
    return idsvc.agg(F.count(F.lit(1)).alias("n_rows"))


def write_identity_index(lookup_rows: DataFrame, path: str, key: str, row_group_bytes: int = 32 << 20,
                         keys_per_group: int = 500_000) -> None:
    """Write (key, uuid) rows sorted by both, so that a key of very many uuids spreads over files too."""
    (lookup_rows.repartitionByRange(key, "uuid").sortWithinPartitions(key, "uuid").write
     .option("parquet.block.size", row_group_bytes)
     .option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option(f"parquet.bloom.filter.expected.ndv#{key}", keys_per_group)
     # a Bloom filter is not written for a column chunk that a dictionary covers
     .option(f"parquet.enable.dictionary#{key}", "false")
     .parquet(path))


def read_keys(index: DataFrame, key: str, wanted: list[str]) -> DataFrame:
    """The rows of ``wanted`` keys, as predicates that reach the row groups' Bloom filters.

    Spark hands lists of more than ten values to Parquet as one range, hence lists of ten.
    """
    some = [F.col(key).isin(wanted[i:i + 10]) for i in range(0, len(wanted), 10)]
    while len(some) > 1:  # a balanced tree, as deep as the logarithm of the batch
        some = [some[i] | some[i + 1] if i + 1 < len(some) else some[i] for i in range(0, len(some), 2)]
    return index.where(some[0] if some else F.lit(False))
