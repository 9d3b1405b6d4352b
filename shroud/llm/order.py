"""Exact prefix sums and cuts of a table in hash order, without one group in one task.

Rows of a group lie in the order of a hash key.  Sums per (group, leading digits) place every
cut in one small bucket, and only the keys of those buckets are sorted.  So a group of any size
is cut exactly while a task holds one bucket.  Repeated rows share a key; a cut may fall between
them, and only the rows of such a key are numbered.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import unused


def cuts(rows: DataFrame, goals: DataFrame, digits: int) -> DataFrame:
    """(g, j, cut, copies): the end of the prefix of group ``g`` that reaches goal ``j``.

    ``rows``: g, key, size; rows of one key have one size.  ``goals``: g, j, goal (a sum of sizes).
    The prefix holds every row whose middle (sum before it plus half its own size) is at most the
    goal, so its sum comes as near to the goal as whole rows allow: all rows of keys before
    ``cut`` and ``copies`` of those that have it.  No row: cut is '', copies 0.  Groups compare
    null-safe.
    """
    d = F.substring("key", 1, digits)
    sums = rows.groupBy("g", d.alias("b")).agg(F.sum("size").alias("s"))
    upto = Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("s").over(upto), F.lit(0)))
    goals = goals.select(F.col("g").alias("gg"), "j", "goal")
    # Middles never fall along the order, so the last row at or below the goal lies in a bucket
    # that begins at or below it: the last such bucket, or the one before where its first row's
    # middle is beyond.
    at = (goals.join(sums, F.col("g").eqNullSafe(F.col("gg")) & (F.col("before") <= F.col("goal")))
          .select("g", "j", "goal", "b", "before"))
    last = Window.partitionBy("g", "j").orderBy(F.desc("b"))
    at = at.withColumn("n", F.row_number().over(last)).where("n <= 2").drop("n")
    inside = (rows.select(F.col("g").alias("rg"), "key", "size", d.alias("rb"))
              .join(at, F.col("rg").eqNullSafe(F.col("g")) & (F.col("rb") == F.col("b")))
              .groupBy("g", "j", "goal", "b", "before", "key")
              .agg(F.max("size").alias("size"), F.count("*").alias("n")))
    run = (Window.partitionBy("g", "j", "b").orderBy("key")
           .rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(run), F.lit(0))
    # copy i ends at start + i * size; the division may round up to the next whole number
    some = F.floor((2 * (F.col("goal") - F.col("start")) + F.col("size")) / (2 * F.col("size")))
    beyond = 2 * F.col("start") + (2 * some - 1) * F.col("size") > 2 * F.col("goal")
    copies = (F.when(F.col("size") > 0, F.least(some - beyond.cast("int"), "n"))
              .when(F.col("start") <= F.col("goal"), F.col("n")).otherwise(0))
    reached = (inside.withColumn("start", start).withColumn("copies", copies.cast("long"))
               .where("copies > 0").groupBy(F.col("g").alias("rg"), F.col("j").alias("rj"))
               .agg(F.max(F.struct(F.col("key").alias("cut"), "copies")).alias("e")))
    return (goals.join(reached, F.col("gg").eqNullSafe(F.col("rg")) & (F.col("j") == F.col("rj")), "left")
            .select(F.col("gg").alias("g"), "j", F.coalesce("e.cut", F.lit("")).alias("cut"),
                    F.coalesce("e.copies", F.lit(0)).cast("long").alias("copies")))


def numbered(rows: DataFrame, path: str, by: list[str], name: str) -> DataFrame:
    """``rows`` with their number from 1 among those equal in ``by`` (null-safe), as ``name``.

    The rows are written to ``path`` and numbered by file and place in it, so a task holds what one
    file has of a group, and tasks that run again give the same numbers.
    """
    rows.write.parquet(path)
    file, place, before, n = (unused(rows, x) for x in ("file", "place", "before", "n"))
    back = rows.sparkSession.read.schema(rows.schema).parquet(path).withColumns(
        {file: F.col("_metadata.file_name"), place: F.col("_metadata.row_index")})
    group = {c: unused(rows, f"group_{i}") for i, c in enumerate((*by, file))}
    upto = Window.partitionBy(*by).orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    files = (back.groupBy(*group).agg(F.count("*").alias(n))
             .select(*(F.col(c).alias(new) for c, new in group.items()),
                     F.coalesce(F.sum(n).over(upto), F.lit(0)).alias(before)))
    same = [F.col(c).eqNullSafe(F.col(new)) for c, new in group.items()]
    own = F.row_number().over(Window.partitionBy(*group).orderBy(place))
    return (back.withColumn(name, own).join(files, reduce(and_, same))
            .withColumn(name, F.col(name) + F.col(before)).drop(file, place, before, *group.values()))
