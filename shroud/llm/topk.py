"""Exact top-k inner-product search by a three-phase uniform threshold.

The dimensions are cut into ``groups``; each group is one score list per query, and a
candidate's score is the sum of its entries in all lists.

1. Every task keeps, per query and list, its k highest entries, resolves their totals and
   reports the k best totals.  The k-th best of all reports is a cutoff that the true k-th
   score cannot fall below.
2. The cutoffs of one block of queries go to every task.  A candidate whose total reaches the
   cutoff has an entry of at least ``cutoff / groups`` in some list (the largest of ``groups``
   numbers is not below their mean), so each task collects exactly the entries that do.
3. The remaining entries of the collected candidates are resolved, exactly, in integers; those
   that reach the cutoff are reported, at most k a query and task, and ranked.

Queries are taken in blocks of ``block`` (the bound on what is sent to the tasks and on the
cutoffs that the driver holds); each block passes over the candidates twice, and no candidate
vector is shuffled.  With ``groups`` lists the second phase collects about
``n * (k / n) ** (1 / groups)`` of n candidates.

Defined cases: a vector that is null, empty or holds a null or non-finite component takes no
part, nor does a row without id.  Vectors are compared only with vectors of the same length.
A query is every distinct id of the query set (of several rows with one id, the smallest vector
asks); its candidates are all rows of other ids, and a repeated row is one more candidate.
Ties go to the smaller id.  Columns besides the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path

SCHEMA = "query_id long, rank int, vec_id long, score long"


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as double; null where the vector takes no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    ok = (F.size(vector) > 0) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(F.coalesce(ok, F.lit(False)),
                  F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _number(rows: np.ndarray, queries: np.ndarray) -> type:
    """The fastest number type in which every inner product is exact."""
    most = rows.shape[1] * float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0))
    if most >= 2.0 ** 62:
        raise ValueError("scores do not fit in a long")
    return np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64


def _entries(rows: np.ndarray, queries: np.ndarray, cuts: list[tuple[int, int]],
             own: np.ndarray) -> list[np.ndarray]:
    """Entries of each list, rows x queries; the query's own row gets the lowest number."""
    kind = _number(rows, queries)
    a, b = rows.astype(kind), queries.astype(kind)
    out = [a[:, i:j] @ b[:, i:j].T for i, j in cuts]
    for p in out:
        p[own] = -np.inf if kind is not np.int64 else -(2 ** 62) // len(cuts)
    return out


def _best(score: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k highest of each column."""
    if score.shape[0] <= k:
        return np.broadcast_to(np.arange(score.shape[0])[:, None], score.shape)
    return np.argpartition(score, score.shape[0] - k, axis=0)[-k:]


def _chunks(batches: Iterator[pa.RecordBatch], dim: int, size: int = 1024):
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            yield (part.column(0).to_numpy(zero_copy_only=False), _matrix(part.column(1), dim))


def _lists(ids: np.ndarray, queries: np.ndarray, cuts, k: int):
    """Phase 1: the totals that head each task's lists."""
    nq, m, low = len(ids), len(cuts), -np.inf

    def run(batches):
        # per list: entry, total and running row number of the k best so far
        entry = np.full((m, k, nq), low)
        total, place = np.full((m, k, nq), low), np.full((m, k, nq), -1, np.int64)
        seen = 0
        for vec, rows in _chunks(batches, queries.shape[1]):
            own = vec[:, None] == ids[None, :]
            parts = _entries(rows, queries, cuts, own)
            whole = sum(p.astype(np.float64) for p in parts)
            for j, p in enumerate(parts):
                top = _best(p, k)
                e = np.concatenate([entry[j], np.take_along_axis(p, top, 0).astype(np.float64)])
                t = np.concatenate([total[j], np.take_along_axis(whole, top, 0)])
                r = np.concatenate([place[j], top + seen])
                keep = _best(e, k)
                entry[j], total[j], place[j] = (np.take_along_axis(x, keep, 0) for x in (e, t, r))
            seen += len(vec)
        total, place = total.reshape(m * k, nq), place.reshape(m * k, nq)
        order = np.argsort(place, axis=0, kind="stable")
        total, place = np.take_along_axis(total, order, 0), np.take_along_axis(place, order, 0)
        total[1:][place[1:] == place[:-1]] = low  # one candidate can head several lists
        total[total < -(2.0 ** 61)] = low  # its own row
        total = -np.sort(-total, axis=0)[:k]
        at = np.nonzero(total > low)
        # float64 rounds totals beyond 2**53: step down, the cutoff only has to be safe
        score = np.where(np.abs(total[at]) < 2 ** 53, total[at],
                         np.nextafter(total[at], low) - 2 ** 10)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[1].astype(np.int32)), pa.array(score.astype(np.int64))],
            names=["q", "score"])

    return run


def _resolve(ids: np.ndarray, queries: np.ndarray, cuts, k: int, cutoff: np.ndarray):
    """Phases 2 and 3: collect by the uniform threshold, resolve, keep what reaches the cutoff."""
    m = len(cuts)
    share = cutoff / m - np.abs(cutoff) * 2.0 ** -50  # rounding must not raise it

    def prune(q, v, s):
        order = np.lexsort((v, -s, q))
        q, v, s = q[order], v[order], s[order]
        first = np.r_[0, np.flatnonzero(q[1:] != q[:-1]) + 1] if len(q) else np.zeros(0, int)
        nth = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        return q[nth < k], v[nth < k], s[nth < k]

    def run(batches):
        kept = (np.zeros(0, np.int64),) * 3
        for vec, rows in _chunks(batches, queries.shape[1]):
            own = vec[:, None] == ids[None, :]
            collected = np.zeros(own.shape, bool)
            for p in _entries(rows, queries, cuts, own):
                collected |= p >= share[None, :]
            collected &= ~own
            r, q = np.nonzero(collected)
            for at in range(0, len(r), 1 << 16):
                ri, qi = r[at:at + (1 << 16)], q[at:at + (1 << 16)]
                s = np.einsum("ij,ij->i", rows[ri], queries[qi])
                ok = s >= cutoff[qi]
                kept = tuple(np.r_[x, y] for x, y in zip(kept, (qi[ok], vec[ri[ok]], s[ok])))
                if len(kept[0]) > 1 << 18:
                    kept = prune(*kept)
        q, v, s = prune(*kept)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[q], pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.int64())],
            names=["query_id", "vec_id", "score"])

    return run


def _blocks(queries: DataFrame, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Query blocks of one vector length each, streamed to the driver a partition at a time."""
    ids, rows = [], []
    for r in queries.orderBy("dim", "id").toLocalIterator():
        if ids and (len(ids) == size or len(r.vec) != len(rows[0])):
            yield np.array(ids, np.int64), np.array(rows, np.int64)
            ids, rows = [], []
        ids.append(r.id)
        rows.append(r.vec)
    if ids:
        yield np.array(ids, np.int64), np.array(rows, np.int64)


def exact_top_k(spark: SparkSession, vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id",
                vector_col: str = "embedding", k: int = 5, groups: int = 2, block: int = 2048,
                scale: int = 256) -> DataFrame:
    """The k highest inner products of each query with all other rows (see the module)."""
    narrow = (vectors.where(F.col(id_col).isNotNull())
              .select(F.col(id_col).cast("long").alias("id"),
                      quantised(F.col(vector_col), scale).alias("vec"), is_query.alias("asks"))
              .where(F.col("vec").isNotNull()))
    asked = (narrow.where("asks").groupBy("id").agg(F.min("vec").alias("vec"))
             .withColumn("dim", F.size("vec")))
    out = scratch_path(spark, "topk")
    spark.createDataFrame([], "query_id long, vec_id long, score long").write.parquet(out)
    for ids, queries in _blocks(asked, block):
        dim = queries.shape[1]
        edges = np.linspace(0, dim, min(groups, dim) + 1).astype(int)
        cuts = list(zip(edges[:-1], edges[1:]))
        rows = narrow.where(F.size("vec") == dim).select("id", "vec")
        heads = rows.mapInArrow(_lists(ids, queries, cuts, k), "q int, score long")
        by_query = Window.partitionBy("q").orderBy(F.desc("score"))
        cutoff = np.full(len(ids), -(2 ** 62))  # fewer than k candidates: all are safe
        for r in heads.withColumn("n", F.row_number().over(by_query)).where(F.col("n") == k).collect():
            cutoff[r.q] = r.score
        rows.mapInArrow(_resolve(ids, queries, cuts, k, cutoff),
                        "query_id long, vec_id long, score long").write.mode("append").parquet(out)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (spark.read.parquet(out).withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
