"""Mixing sources to target weights by capped water-filling.

A source's target is ``min(cap, level * weight)`` with the level at which the targets use the
whole budget: sources above their cap (``epochs`` times their size) are clamped and the excess
goes to the others by weight until none is above.  The level rises to its value in a few rounds;
each is one aggregate over the table of sources and leaves one number on the driver.

Sampling: a source repeats whole ``floor(target / size)`` times, and the remaining fraction is a
seeded sample: the source's documents in the order of a hash of seed, id and text, up to
the document whose middle still lies within the fraction (exact, by ``order.cuts``).  So a
source's taken words differ from its target by half a document at most, and reruns agree.
Repeated rows (same id and text) stand one behind the other and may be parted by the cut; only
the rows that share a cut's key are numbered.

Size: number of words ``[^\\x20\\x09-\\x0D]+`` (null: 0).  Weights go by the rank of the source by
code point, null last, through the list ``weights`` again and again.  Budget: ``share`` of all
sizes.  Defined cases: documents without words are never taken; a source without words has
target 0.  Empty table: no row.  If all
sources hit their cap, the targets are the caps.  Other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path
from .common import digits_for, hash_key, unused
from .order import cuts, numbered

SEED, WEIGHTS, SHARE, EPOCHS = 7, (5, 2, 1), 1.5, 2


def word_count(text: Column) -> Column:
    """Number of runs of other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sample_key(id_col: str, text_col: str, seed: int) -> Column:
    return hash_key(seed, F.col(id_col), F.md5(F.col(text_col)))


def water_fill(sources: DataFrame, budget: float, epochs: int = EPOCHS) -> float:
    """The level for ``sources`` (size long, weight int): a scalar, from aggregates only."""
    cap = F.col("size") * epochs
    level, clamped = 0.0, -1
    while True:
        above = cap <= F.col("weight") * F.lit(level)
        r = sources.where("size > 0").agg(
            F.sum(F.when(above, cap).otherwise(0)).alias("caps"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weights"),
            F.count_if(above).alias("n"), F.max(cap / F.col("weight")).alias("most")).head()
        if not r.weights:  # nothing to share, or all clamped
            return r.most or 0.0
        if r.n == clamped:
            return level
        level, clamped = max(level, (budget - r.caps) / r.weights), r.n


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """g, size, docs, target, whole, goal of every source ``g`` of ``rows`` (g, size)."""
    spark = rows.sparkSession
    path = scratch_path(spark, "mixing-sources")
    (rows.groupBy("g").agg(F.sum("size").alias("size"), F.count("*").alias("docs"))
     .write.parquet(path))
    sums = spark.read.parquet(path)
    # the rank needs the sources (not their documents) in one order
    rank = F.row_number().over(Window.orderBy(F.col("g").isNull(), "g")) - 1
    cycle = F.array(*(F.lit(int(w)) for w in weights))
    sources = sums.withColumn("weight", F.element_at(cycle, (rank % len(weights) + 1).cast("int")))
    path = scratch_path(spark, "mixing-weights")
    sources.write.parquet(path)
    sources = spark.read.parquet(path)
    budget = share * (sources.agg(F.sum("size")).head()[0] or 0)
    level = water_fill(sources, budget, epochs)
    target = F.least(F.col("size") * F.lit(float(epochs)), F.col("weight") * F.lit(level))
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0)
    return (sources.withColumn("target", target).withColumn("whole", whole.cast("int"))
            .withColumn("goal", F.col("target") - F.col("whole") * F.col("size")))


def _repetitions(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int,
                 weights, share: float, epochs: int) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, g, size, key) and, a row a source, how its documents repeat: __g,
    __source_size, __target, __whole, __cut (the last key that is taken once more), __copies (so
    many of the rows that have it)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "mixing")
    docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("g"),
                word_count(F.col(text_col)).alias("size"),
                sample_key(id_col, text_col, seed).alias("key")).write.parquet(path)
    rows = spark.read.parquet(path)
    filled = targets(rows.select("g", "size"), weights, share, epochs)
    total = filled.agg(F.sum("docs")).head()[0] or 0
    goals = filled.select("g", F.lit(0).alias("j"), "goal")
    cut = cuts(rows, goals, digits_for(total)).select(F.col("g").alias("cg"), "cut", "copies")
    out = (filled.join(cut, F.col("g").eqNullSafe(F.col("cg")))
           .select(F.col("g").alias("__g"), F.col("size").alias("__source_size"),
                   F.col("target").alias("__target"), F.col("whole").alias("__whole"),
                   F.col("cut").alias("__cut"), F.col("copies").alias("__copies")))
    path = scratch_path(spark, "mixing-plan")
    out.write.parquet(path)
    return rows, spark.read.parquet(path)  # its size is now known: broadcast only if small


def _with_repeats(rows: DataFrame, plan: DataFrame, g: str, key: str, name: str) -> DataFrame:
    """``rows`` with the columns of ``plan`` and the number of times each is taken, as ``name``."""
    planned = rows.join(plan, F.col(g).eqNullSafe(F.col("__g")))
    clear = planned.where(F.col(key) != F.col("__cut")).withColumn(
        name, F.col("__whole") + (F.col(key) < F.col("__cut")).cast("int"))
    copies = numbered(planned.where(F.col(key) == F.col("__cut")),
                      scratch_path(rows.sparkSession, "mixing-copies"), [g], name)
    return clear.unionByName(copies.withColumn(
        name, F.col("__whole") + (F.col(name) <= F.col("__copies")).cast("int")))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", seed: int = SEED, weights=WEIGHTS, share: float = SHARE,
        epochs: int = EPOCHS) -> DataFrame:
    """doc_id, size, source_size, target, repeats, taken of every row."""
    rows, plan = _repetitions(docs, id_col, text_col, source_col, seed, weights, share, epochs)
    return (_with_repeats(rows, plan, "g", "key", "times")
            .withColumn("repeats", F.when(F.col("size") == 0, 0).otherwise(F.col("times")))
            .select("doc_id", "size", F.col("__source_size").alias("source_size"),
                    F.col("__target").alias("target"), "repeats",
                    (F.col("size") * F.col("repeats")).cast("long").alias("taken")))


def mixed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", seed: int = SEED, weights=WEIGHTS, share: float = SHARE,
          epochs: int = EPOCHS) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as it is taken."""
    _, plan = _repetitions(docs, id_col, text_col, source_col, seed, weights, share, epochs)
    key, times = unused(docs, "key"), unused(docs, "times")
    rows = (docs.where(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"))
            .withColumn(key, sample_key(id_col, text_col, seed)))
    return (_with_repeats(rows, plan, source_col, key, times).where(F.col(times) > 0)
            .withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
            .select(*docs.columns))
