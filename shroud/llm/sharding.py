"""Resharding that moves the fewest bytes: a minimum-cost flow over shard sizes.

1. Sizes of the old shards are summed (the only thing the driver sees: one number a shard).
2. A flow from old shards to new ones with the given capacities is solved; a byte costs
   ``cost(old, new)``, by default 0 where it stays and 1 where it moves.
3. Documents of an old shard lie in hash order, so the flow's arcs are consecutive blocks of
   them.  Their ends are found exactly (``order.cuts``), and a document goes where its middle
   byte falls: a block is off its arc by half a document at most.  An end may fall between
   repeated rows (same id and text); those of an end's key are numbered, no others.
4. The documents are dealt by (shard, hash bucket, input partition) in one shuffle and written
   under ``shard=<n>``; shards that lose and gain nothing are not rewritten.  A row's slot is its
   place in its shard: the rows of the files before its own, and its place in that file.

Sizes: UTF-8 bytes of the text (null: none) plus 1.  Law ``bytes``: equal capacities.

Defined cases: old shards may be named by any value, null included; a new shard is the successor
of the old one with its number as name.  Empty table: no row, no flow.  Input columns named like the output's are replaced; others stay.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path
from .common import digits_for, hash_key, unused
from .order import cuts, numbered

SEED = 20


def min_cost_flow(supply: list[int], capacity: list[int],
                  cost: Callable[[int, int], int]) -> list[list[int]]:
    """flow[i][j] of least cost that ships all supply within the capacities.

    Successive cheapest augmenting paths (Bellman-Ford by queue).  The network has one node a
    shard, so it does not grow with the data.
    """
    n, m = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("capacities are too small")
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    while any(left):
        # nodes 0..n-1 old, n..n+m-1 new; start from every old shard with bytes left
        dist = [0 if i < n and left[i] else None for i in range(n + m)]
        came: list[int | None] = [None] * (n + m)
        queue = deque(i for i in range(n) if left[i])
        while queue:
            u = queue.popleft()
            arcs = (((n + j, cost(u, j)) for j in range(m)) if u < n else
                    ((i, -cost(i, u - n)) for i in range(n) if flow[i][u - n]))
            for v, c in arcs:
                if dist[v] is None or dist[u] + c < dist[v]:
                    dist[v], came[v] = dist[u] + c, u
                    queue.append(v)
        end = min((n + j for j in range(m) if room[j]), key=lambda v: (dist[v], v))
        path = [end]
        while came[path[-1]] is not None:
            path.append(came[path[-1]])
        path.reverse()
        amount = min(left[path[0]], room[end - n],
                     *(flow[v][u - n] for u, v in zip(path, path[1:]) if u >= n))
        for u, v in zip(path, path[1:]):
            if u < n:
                flow[u][v - n] += amount
            else:
                flow[v][u - n] -= amount
        left[path[0]] -= amount
        room[end - n] -= amount
    return flow


@dataclass
class Resharding:
    """old: names of the old shards; flow[i][j]: bytes from old i to new j."""

    old: list
    capacity: list[int]
    flow: list[list[int]]
    cut_keys: DataFrame  # g, j, cut, copies
    digits: int

    def stays(self, i: int, j: int) -> bool:
        return str(self.old[i]) == str(j)

    @property
    def moved(self) -> int:
        return sum(x for i, row in enumerate(self.flow) for j, x in enumerate(row)
                   if not self.stays(i, j))

    @property
    def affected(self) -> set[int]:
        """New shards that gain bytes, or whose old shard loses some."""
        return {k for i, row in enumerate(self.flow) for j, x in enumerate(row)
                if x and not self.stays(i, j)
                for k in ([j] + [k for k in range(len(self.capacity)) if self.stays(i, k)])}


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _arcs(plan: Resharding, i: int) -> list[tuple[int, int]]:
    """(new shard, bytes) of one old shard: what stays first."""
    row = [(j, x) for j, x in enumerate(plan.flow[i]) if x]
    return sorted(row, key=lambda a: (not plan.stays(i, a[0]), a[0]))


def _narrow(docs: DataFrame, old: Column, id_col: str, text_col: str) -> DataFrame:
    return docs.select(old.cast("string").alias("g"), size_of(F.col(text_col)).alias("size"),
                       hash_key(SEED, F.col(id_col), F.md5(F.col(text_col))).alias("key"))


def plan_reshard(docs: DataFrame, old: Column, shards: int, *, id_col: str = "doc_id",
                 text_col: str = "text", capacity: list[int] | None = None,
                 cost: Callable[[int, int], int] | None = None) -> Resharding:
    """Solve the flow and place its block ends.  ``old``: the old shard of a row (few values)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "reshard-sizes")
    _narrow(docs, old, id_col, text_col).write.parquet(path)
    rows = spark.read.parquet(path)
    sums = sorted(rows.groupBy("g").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect(),
                  key=lambda r: (r.g is None, r.g or ""))
    names, supply = [r.g for r in sums], [r.s for r in sums]
    total = sum(supply)
    capacity = capacity or [total // shards + (j < total % shards) for j in range(shards)]
    plan = Resharding(names, capacity, [], None, digits_for(sum(r.n for r in sums)))
    plan.flow = min_cost_flow(supply, capacity,
                              cost or (lambda i, j: 0 if plan.stays(i, j) else 1))
    goals = []
    for i, name in enumerate(names):
        at = 0
        for j, (_, x) in enumerate(_arcs(plan, i)[:-1]):
            at += x
            goals.append((name, j, at))
    plan.cut_keys = cuts(rows, spark.createDataFrame(goals, "g string, j int, goal long"), plan.digits)
    return plan


def assign(docs: DataFrame, plan: Resharding, old: Column, *, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``docs`` with size and shard, dealt for writing; one shuffle of the documents."""
    spark = docs.sparkSession
    ends: dict = {}
    for r in plan.cut_keys.collect():  # at most one row an arc
        ends.setdefault(r.g, {})[r.j] = (r.cut, r.copies)
    table = [(name, [ends.get(name, {}).get(j, ("", 0)) for j in range(len(_arcs(plan, i)) - 1)],
              [a[0] for a in _arcs(plan, i)]) for i, name in enumerate(plan.old)]
    g, key, copy, bucket, part, e, new = (
        unused(docs, x) for x in ("g", "key", "copy", "bucket", "part", "ends", "new"))
    arcs = F.broadcast(spark.createDataFrame(  # a row for each old shard
        table, "oldg string, arc_ends array<struct<cut: string, copies: long>>, arc_new array<int>")
        .select(F.col("oldg").alias("__g"), F.col("arc_ends").alias(e), F.col("arc_new").alias(new)))
    same = F.col(g).eqNullSafe(F.col("__g"))
    at_end = F.exists(e, lambda c: c["cut"] == F.col(key))
    rows = docs.withColumns({g: old.cast("string"), key: hash_key(SEED, F.col(id_col), F.md5(F.col(text_col))),
                             "size": size_of(F.col(text_col))})
    planned = rows.join(arcs, same)
    copies = numbered(planned.where(at_end).select(*rows.columns), scratch_path(spark, "reshard-copies"),
                      [g, key], copy)
    out = (planned.where(~at_end).withColumn(copy, F.lit(0).cast("long"))
           .unionByName(copies.join(arcs, same)))
    beyond = f"`{key}` > c.cut or (`{key}` = c.cut and `{copy}` > c.copies)"
    return (out.withColumns({"shard": F.expr(f"`{new}`[size(filter(`{e}`, c -> {beyond}))]"),
                             bucket: F.substring(key, 1, plan.digits), part: F.spark_partition_id()})
            .repartition("shard", bucket, part).sortWithinPartitions("shard", key)
            .drop("__g", g, key, copy, bucket, part, e, new))


def rewrite(assigned: DataFrame, path: str, only: set[int] | None = None) -> None:
    """Write the shards (or the affected ones only) as ``path/shard=<n>/``."""
    rows = assigned if only is None else assigned.where(F.col("shard").isin(sorted(only)))
    rows.write.partitionBy("shard").parquet(path)


def with_slots(shards: DataFrame) -> DataFrame:
    """Rows read from shard files with their slot, their place in the shard."""
    file, place, before = (unused(shards, x) for x in ("file", "place", "before"))
    rows = shards.withColumns({file: F.col("_metadata.file_name"), place: F.col("_metadata.row_index")})
    upto = Window.partitionBy("shard").orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    files = (rows.groupBy("shard", file).agg(F.count("*").alias("__n"))
             .select(F.col("shard").alias("__s"), F.col(file).alias("__f"),
                     F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias(before)))
    return (rows.join(files, (F.col("shard") == F.col("__s")) & (F.col(file) == F.col("__f")))
            .withColumn("slot", F.col(before) + F.col(place)).drop("__s", "__f", file, place, before))


def reshard(spark: SparkSession, docs: DataFrame, old: Column, shards: int = 8, *,
            id_col: str = "doc_id", text_col: str = "text", path: str | None = None
            ) -> tuple[DataFrame, Resharding]:
    """All documents in their new shard files, read back, and the plan that was followed."""
    plan = plan_reshard(docs, old, shards, id_col=id_col, text_col=text_col)
    path = path or scratch_path(spark, "shards")
    out = assign(docs, plan, old, id_col=id_col, text_col=text_col)
    rewrite(out, path)
    return with_slots(spark.read.schema(out.schema).parquet(path)), plan


def reshard_files(spark: SparkSession, root: str, new_root: str, shards: int, **columns
                  ) -> tuple[dict[int, str], Resharding]:
    """Reshard the files ``root/shard=<n>/``: the folder of every new shard, and the plan.

    Only the affected shards are written, under ``new_root``; the others keep their folder.
    """
    docs = spark.read.parquet(root)
    plan = plan_reshard(docs, F.col("shard"), shards, **columns)
    old = unused(docs, "old")
    moved = docs.withColumnRenamed("shard", old)
    out = assign(moved, plan, F.col(old), **columns).drop(old)
    rewrite(out if "size" in docs.columns else out.drop("size"), new_root, plan.affected)
    return {j: f"{new_root if j in plan.affected else root}/shard={j}" for j in range(shards)}, plan
