"""Hard negatives by anchor-clustered shared lists.

Anchors are grouped by spherical k-means.  The members of a group, at most ``members`` at a time,
share one list of candidates: with the centre c of the members (their mean direction) and the
largest angle t between c and a member, no member u scores above ``|u| * |x| * cos(angle(x, c) - t)``
with a candidate x (an angle below 0 counts as 0).  The candidates are sorted by that bound, without
``|u|``, once a group; every member walks the list in this order and stops where the bound of what
remains falls below what it still needs.  So nothing is lost, whatever the grouping.

Two walks answer a run.  The first finds an anchor's positives: the ``positives`` highest scores
among other rows of its label.  The second finds, for each positive, the ``negatives`` highest scores
among rows of other labels within ``low`` to 100 per cent of the positive's score.

Candidates are dealt evenly, by a hash of the row, into slabs of at most ``slab`` rows; a task holds
one slab and streams the anchors past it group by group, so its memory is a slab and one group.
Every anchor visits every slab: rows shuffled are candidates plus anchors times slabs.  A walk in a
slab is certified for that slab; the best of all slabs are ranked by Spark.  The group centres are
fit on at most ``FIT`` anchors (chosen by a seeded hash); they steer speed, never results, and are the
only thing sent to every task (``FIT`` vectors at most).

Components become ``floor(scale * x)``; scores are exact integers.  Defined cases: a row without id or
label, or with a vector that is null, empty or holds a null or non-finite component takes no part.
Vectors are compared only with vectors of the same length, rows never with rows of their own id.  Of
several anchor rows with one id the smallest (vector, label) asks; a repeated row is one more
candidate.  Ties go to the smaller id.  A positive with a negative score has no negatives.  Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import default_parallelism, scratch_path
from .topk import quantised

SLAB, MEMBERS, CLUSTERS, FIT, SEED = 1 << 17, 256, 64, 4096, 13
#: Above every score.
NEVER = 1 << 62


def _units(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(directions, lengths); the zero vector keeps direction zero."""
    size = np.sqrt(np.einsum("ij,ij->i", v, v))
    return v / np.maximum(size, 1e-300)[:, None], size


def fit_centres(vectors: np.ndarray, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """At most ``k`` directions by spherical k-means."""
    x, _ = _units(vectors.astype(np.float64))
    rng = np.random.RandomState(seed)
    c = x[np.sort(rng.permutation(len(x))[:k])]
    for _ in range(10):
        own = (x @ c.T).argmax(axis=1)
        c, _ = _units(np.array([x[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(len(c))]))
    return c


class Slab:
    """Candidates of one vector length, and the lists over them."""

    def __init__(self, ids: np.ndarray, labels: list[str], vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.code: dict[str, int] = {}
        self.labels = np.array([self.code.setdefault(x, len(self.code)) for x in labels], np.int64)
        self.unit, self.size = _units(vectors.astype(np.float64))
        self.most = int(np.abs(vectors).max(initial=0))

    def shared_list(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order of the candidates, their bounds for an anchor of length 1), highest first."""
        u, size = _units(anchors.astype(np.float64))
        c, _ = _units(u.sum(axis=0)[None, :])
        c = c[0]
        spread = np.arccos(np.clip(u[size > 0] @ c, -1, 1)).max(initial=0.0)
        angle = np.arccos(np.clip(self.unit @ c, -1, 1))
        # the margin covers the rounding of the angles
        bound = self.size * np.cos(np.clip(angle - spread - 1e-7, 0, np.pi))
        order = np.argsort(-bound, kind="stable")
        return order, bound[order]

    def kind(self, anchors: np.ndarray) -> type:
        """The fastest number type in which every inner product is exact."""
        most = anchors.shape[1] * float(self.most) * float(np.abs(anchors).max(initial=0))
        if most >= 2.0 ** 62:
            raise ValueError("scores do not fit in a long")
        return np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64

    def walk(self, ids: np.ndarray, anchors: np.ndarray, lists: int, k: int,
             admit: Callable, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ``k`` best of this slab for every (member, list): member, list, row, score.

        ``admit(scores, rows, members, list)`` masks what may enter a list; ``least`` (members x lists)
        is the lowest score of use there, ``NEVER`` for a list that takes nothing."""
        order, bound = self.shared_list(anchors)
        kind = self.kind(anchors)
        a, length = anchors.astype(kind), _units(anchors.astype(np.float64))[1]
        need = least.copy()
        kept = [np.zeros(0, np.int64)] * 4  # member, list, row, score
        at, step = 0, 256
        while at < len(order):
            # rounding must not stop a walk early: the bound is taken a little higher
            top = length * bound[at] + np.abs(length * bound[at]) * 1e-9 + 1e-6
            going = np.flatnonzero((top[:, None] >= need).any(axis=1))
            if not len(going):
                break
            rows = order[at:at + step]
            score = self.vectors[rows].astype(kind) @ a[going].T
            other = self.ids[rows][:, None] != ids[going][None, :]
            found = [kept]
            for j in range(lists):
                ok = other & (score >= need[going, j][None, :]) & admit(score, rows, going, j)
                r, m = np.nonzero(ok)
                found.append([going[m], np.full(len(r), j), rows[r], score[r, m].astype(np.int64)])
            m, j, r, s = (np.concatenate(x) for x in zip(*found))
            best = np.lexsort((self.ids[r], -s, j, m))
            m, j, r, s = m[best], j[best], r[best], s[best]
            slot = m * lists + j
            first = np.r_[0, np.flatnonzero(slot[1:] != slot[:-1]) + 1] if len(slot) else np.zeros(0, np.int64)
            nth = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
            kth = nth == k - 1
            need[m[kth], j[kth]] = np.maximum(need[m[kth], j[kth]], s[kth])
            kept = [x[nth < k] for x in (m, j, r, s)]
            at, step = at + len(rows), min(2 * step, 8192)
        return tuple(kept)


def _per_row(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Runs of rows that agree in (slab, anchor, length, cluster)."""
    for b in batches:
        if not b.num_rows:
            continue
        dim = np.diff(b.column("vec").offsets.to_numpy())
        key = np.stack([b.column("slab").to_numpy(), b.column("anchor").to_numpy(zero_copy_only=False).astype(int),
                        dim, b.column("cluster").to_numpy()])
        edge = np.r_[0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, b.num_rows]
        for i, j in zip(edge[:-1].tolist(), edge[1:].tolist()):
            yield tuple(key[:, i].tolist()), b.slice(i, j - i)


def _joined(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, list, np.ndarray, pa.Table]:
    t = pa.Table.from_batches(parts).combine_chunks()
    vec = t.column("vec").combine_chunks()
    flat = vec.flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
    return t.column("id").to_numpy(), t.column("label").to_pylist(), flat, t


def _walker(members: int, answer: Callable) -> Callable:
    """Task function over rows sorted by slab, candidates before anchors: ``answer`` of each group."""
    def run(batches):
        slabs: dict[int, Slab] = {}       # by vector length, of the slab at hand
        number, held, what = None, [], None

        def close():
            nonlocal held
            out = None
            if held and what[1]:
                if what[2] in slabs:
                    ids, labels, vec, t = _joined(held)
                    out = answer(slabs[what[2]], ids, labels, vec, t)
            elif held:
                ids, labels, vec, _ = _joined(held)
                slabs[what[2]] = Slab(ids, labels, vec)
            held = []
            return out

        for key, part in _per_row(batches):
            while part.num_rows:
                if what is not None and (key != what or (what[1] and sum(p.num_rows for p in held) >= members)):
                    out = close()
                    if out is not None and out.num_rows:
                        yield out
                if key[0] != number:
                    slabs, number = {}, key[0]
                what = key
                room = members - sum(p.num_rows for p in held) if key[1] else part.num_rows
                held.append(part.slice(0, room))
                part = part.slice(room)
        if what is not None:
            out = close()
            if out is not None and out.num_rows:
                yield out

    return run


def _positives(k: int) -> Callable:
    def answer(slab: Slab, ids, labels, vec, t):
        own = np.array([slab.code.get(x, -1) for x in labels])

        def same(score, rows, going, j):
            return slab.labels[rows][:, None] == own[going][None, :]

        m, _, r, s = slab.walk(ids, vec, 1, k, same, np.full((len(ids), 1), -NEVER))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[m], pa.int64()), pa.array(slab.ids[r], pa.int64()), pa.array(s, pa.int64())],
            names=["anchor_id", "positive_id", "positive_score"])

    return answer


def _negatives(k: int, low: int, lists: int) -> Callable:
    def answer(slab: Slab, ids, labels, vec, t):
        goals = t.column("goals").to_pylist()  # positive scores, the highest first
        own = np.array([slab.code.get(x, -1) for x in labels])
        least, most = np.full((len(ids), lists), NEVER), np.full((len(ids), lists), -NEVER)
        for i, g in enumerate(goals):
            for j, p in enumerate(g or []):
                if p >= 0:
                    least[i, j], most[i, j] = -(-low * p // 100), p

        def other(score, rows, going, j):
            return (score <= most[going, j][None, :]) & (slab.labels[rows][:, None] != own[going][None, :])

        m, j, r, s = slab.walk(ids, vec, lists, k, other, least)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[m], pa.int64()), pa.array(j, pa.int32()), pa.array(slab.ids[r], pa.int64()),
             pa.array(s, pa.int64())], names=["anchor_id", "nth", "negative_id", "negative_score"])

    return answer


def _first(rows: DataFrame, by: list[str], score: str, ident: str, k: int, rank: str) -> DataFrame:
    best = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(ident))
    return rows.withColumn(rank, F.row_number().over(best).cast("int")).where(F.col(rank) <= k)


def _clustered(anchors: DataFrame, clusters: int) -> DataFrame:
    """The anchors with the number of their nearest centre (of centres of the same length)."""
    some = (anchors.orderBy(F.xxhash64(F.lit(SEED), "id"), "id").limit(FIT).select("vec").collect())
    by_length: dict[int, list] = {}
    for r in some:
        by_length.setdefault(len(r.vec), []).append(r.vec)
    centres = {d: fit_centres(np.array(v), clusters) for d, v in by_length.items()}

    def run(batches):
        for b in batches:
            own = []
            for v in b.column(b.num_columns - 1).to_pylist():
                c = centres.get(len(v))
                own.append(0 if c is None else int((c @ np.array(v, np.float64)).argmax()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own, pa.int32())],
                                             names=[*b.schema.names, "cluster"])

    return anchors.mapInArrow(run, anchors.withColumn("cluster", F.lit(0)).schema)


def mine_hard_negatives(spark: SparkSession, vectors: DataFrame, is_anchor: Column, *,
                        id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                        positives: int = 5, negatives: int = 5, low: int = 80, scale: int = 256,
                        slab: int = SLAB, members: int = MEMBERS, clusters: int = CLUSTERS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score (see the module)."""
    path = scratch_path(spark, "negatives")
    (vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
     .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
             is_anchor.alias("asks"), quantised(F.col(vector_col), scale).alias("vec"))
     .where("vec is not null").write.parquet(path))
    rows = spark.read.parquet(path)
    slabs = max(default_parallelism(spark), -(-rows.count() // slab))
    # equal rows are spread too: their place in the file is part of the hash
    place = F.xxhash64("id", "label", F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    candidates = rows.select(F.pmod(place, F.lit(slabs)).cast("int").alias("slab"), F.lit(False).alias("anchor"),
                             "id", "label", "vec", F.lit(-1).alias("cluster"),
                             F.lit(None).cast("array<long>").alias("goals"))
    asked = (rows.where("asks").groupBy("id").agg(F.min(F.struct("vec", "label")).alias("r"))
             .select("id", "r.label", "r.vec"))
    path = scratch_path(spark, "anchors")
    _clustered(asked, clusters).write.parquet(path)
    anchors = spark.read.parquet(path)

    def walked(asking: DataFrame, answer: Callable, schema: str) -> DataFrame:
        every = asking.select(F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))).alias("slab"),
                              F.lit(True).alias("anchor"), "id", "label", "vec", "cluster", "goals")
        return (candidates.unionByName(every).repartitionById(slabs, F.col("slab"))
                .sortWithinPartitions("slab", "anchor", F.size("vec"), "cluster", "id")
                .mapInArrow(_walker(members, answer), schema))

    found = walked(anchors.withColumn("goals", F.lit(None).cast("array<long>")), _positives(positives),
                   "anchor_id long, positive_id long, positive_score long")
    path = scratch_path(spark, "positives")
    (_first(found, ["anchor_id"], "positive_score", "positive_id", positives, "nth")
     .withColumn("nth", F.col("nth") - 1).write.parquet(path))
    near = spark.read.parquet(path)
    goals = (near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("nth", "positive_score"))).alias("g"))
             .select(F.col("anchor_id").alias("id"), F.col("g.positive_score").alias("goals")))
    hard = walked(anchors.join(goals, "id"), _negatives(negatives, low, positives),
                  "anchor_id long, nth int, negative_id long, negative_score long")
    hard = _first(hard, ["anchor_id", "nth"], "negative_score", "negative_id", negatives, "rank")
    return near.join(hard, ["anchor_id", "nth"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
