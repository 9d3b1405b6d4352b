"""Run metrics as a small DataFrame ``(job, metric, value, value_text)``.

Counts are taken with ``DataFrame.observe`` while the data is written, so
no extra pass over the data is needed; only the handful of numbers reaches
the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.text import format_count

METRICS = StructType([StructField("job", StringType(), False),
                      StructField("metric", StringType(), False),
                      StructField("value", LongType(), True)])


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter attached; read ``obs.get[name]`` after an action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(name)), obs


def observed(obs: Observation, name: str, df: DataFrame) -> int:
    """The observed count; where the optimiser dropped the observing node (an
    empty input removes it from the plan), the rows of ``df`` counted directly."""
    try:
        return int(obs.get[name])
    except Exception as e:  # noqa: BLE001 - the JVM's assertion arrives as one of several types
        if not isinstance(e, KeyError) and "AssertionError" not in f"{type(e).__name__} {e}":
            raise
    return count_rows({name: df})[name]


def metrics_frame(spark: SparkSession, job: str, values: dict[str, int]) -> DataFrame:
    rows = [(job, k, None if v is None else int(v)) for k, v in values.items()]
    df = spark.createDataFrame(rows, METRICS)
    return df.withColumn("value_text", format_count("value"))


def count_rows(dfs: dict[str, DataFrame]) -> dict[str, int]:
    """Row counts of several frames (each one aggregation job)."""
    return {k: int(v.agg(F.count(F.lit(1)).alias("n")).first()["n"]) for k, v in dfs.items()}


def content_columns(columns: list[str], blank_is_null: bool = False) -> list[Column]:
    """rows, and the sums of two independent 64-bit hashes of each row: an order-free checksum of a
    multiset of rows.  A lost row and a doubled one do not cancel.

    ``blank_is_null``: for formats that read '' back as NULL."""
    marks = []
    for c in columns:
        value = F.nullif(F.col(c), F.lit("")) if blank_is_null else F.col(c)
        # a NULL leaves the hash as it is, so that values could change places
        marks += [value, value.isNull()]
    sums = [F.coalesce(F.sum(F.xxhash64(F.lit(seed), *marks).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))
            .cast("string").alias(f"sum{seed}") for seed in (1, 2)]
    return [F.count(F.lit(1)).alias("rows"), *sums]


def content(df: DataFrame, columns: list[str] | None = None, blank_is_null: bool = False) -> tuple:
    """(rows, checksum, checksum) of a frame."""
    return tuple(df.agg(*content_columns(columns or df.columns, blank_is_null)).first())


def marked(df: DataFrame, name: str, blank_is_null: bool = False) -> tuple[DataFrame, Observation]:
    """``df`` with its content observed in the stage that an action ends with; see ``seen``."""
    obs = Observation(name)
    return df.observe(obs, *content_columns(df.columns, blank_is_null)), obs


def seen(obs: Observation, df: DataFrame, blank_is_null: bool = False) -> tuple:
    """The observed content; where the optimiser dropped the observing node, that of ``df`` itself."""
    try:
        got = obs.get
        return got["rows"], got["sum1"], got["sum2"]
    except Exception as e:  # noqa: BLE001 - the JVM's assertion arrives as one of several types
        if not isinstance(e, KeyError) and "AssertionError" not in f"{type(e).__name__} {e}":
            raise
    return content(df, blank_is_null=blank_is_null)
