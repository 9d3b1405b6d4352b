"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(low, "u").where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): for every node of an edge (a, b), the smallest node of its component.

    Each round is written to the shared scratch folder, which cuts the lineage and survives lost
    executors; only a row count and a checksum reach the driver.  Self-loops and repeated edges
    are allowed; a node that has none but a self-loop is left out.
    """
    spark = edges.sparkSession

    def settle(e: DataFrame) -> tuple[DataFrame, tuple]:
        path = scratch_path(spark, "components")
        e.distinct().write.parquet(path)
        e = spark.read.parquet(path)
        # an order-free checksum; decimal, as a sum of longs may overflow
        return e, tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())

    e, mark = settle(edges.where("a != b").select("a", "b"))
    for _ in range(max_rounds):
        before = mark
        e, mark = settle(_small_star(_large_star(e)))
        if mark == before:
            roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
