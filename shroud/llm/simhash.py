"""SimHash near-duplicates by a generalised pigeonhole search.

A document's fingerprint has bit b set if more than half of its shingles' XXH64 values have it.
Equal fingerprints are one node.  Links join nodes at ``max_bits`` or fewer differing bits:

1. A bounded sample of nodes gives the correlation of the 64 bits and, per partition and
   threshold, an estimate of the pairs that would become candidates.
2. Correlated bits are grouped into m partitions; dynamic programming gives each partition its
   own threshold t_i (or none, -1) with sum(t_i) = max_bits - m + 1, which loses no pair: if all
   partitions differed by more than t_i bits, the whole would differ by at least
   sum(t_i + 1) = max_bits + 1.  m and the thresholds have the least estimated cost of probes
   and candidates; they change the work, never the result.
3. Each node is dealt under its partition value and all values within t_i bits (the probes);
   nodes that meet under a key are compared whole, and a spanning forest of the true links
   leaves the task, so that a large group gives fewer links than members, not all pairs.
   A key with over ``cell`` nodes is cut into blocks whose pairs are compared in separate cells.
4. Components of the links, by stars; a component's id is its smallest document id.

Defined cases: text without words (null, empty) has fingerprint zero and is linked like any
other; fewer words than a shingle make one shingle of all.  Documents without id take part and
get their component's smallest id (null if none has one).  Repeated rows stay.  No row: no row.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import LOWER_BYTES, as_bytes, hash_key, slices, unused
from .components import components

SHINGLE, MAX_BITS = 4, 4


# ------------------------------------------------------------------ fingerprints

def _shingle_hashes(tokens: list[bytes], n: int):
    """XXH64 (seed 42) of the space-joined shingles, in blocks of bounded length."""
    if len(tokens) <= n:
        yield [xxhash.xxh64_intdigest(b" ".join(tokens), 42)]
        return
    step = 1 << 16
    for at in range(0, len(tokens) - n + 1, step):
        part = tokens[at:at + step + n - 1]
        line = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1]
        yield [xxhash.xxh64_intdigest(line[i:j], 42)
               for i, j in zip(starts[:len(part) - n + 1].tolist(), ends[n - 1:].tolist())]


def fingerprint(text: bytes, n: int = SHINGLE) -> int:
    """The 64-bit fingerprint, as a signed long."""
    tokens = text.translate(LOWER_BYTES).split()
    if not tokens:
        return 0
    ones, total = np.zeros(64, np.int64), 0
    for hashes in _shingle_hashes(tokens, n):
        h = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(h, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
        total += len(h)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, text_col: str, keep: list, n: int = SHINGLE) -> DataFrame:
    """The ``keep`` columns and ``fp``, the fingerprint as a long."""
    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = rows.drop("__text").withColumn("fp", F.lit(0).cast("long")).schema
    at = len(keep)

    def run(batches):
        for batch in batches:
            for part in slices(batch, at):
                fps = [fingerprint(t, n) for t in as_bytes(part.column(at)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:at], pa.array(fps, pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema)


# ------------------------------------------------------------------ plan of the search

def _groups(bits: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of near-equal width that hold correlated bits together, greedily."""
    b = bits - bits.mean(axis=0)
    spread = np.sqrt((b ** 2).sum(axis=0))
    tied = np.abs(b.T @ b) / np.maximum(np.outer(spread, spread), 1e-9)
    np.fill_diagonal(tied, 0)
    left, out = set(range(64)), []
    for i in range(m):
        width = (64 - sum(map(len, out))) // (m - i)
        free = sorted(left)
        part = [max(free, key=lambda x: (tied[x, free].sum(), -x))]
        left.discard(part[0])
        while len(part) < width:
            nxt = max(sorted(left), key=lambda x: (tied[x, part].mean(), -x))
            part.append(nxt)
            left.discard(nxt)
        out.append(sorted(part))
    return out


def _allocate(cost: np.ndarray, total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with the given sum and the least sum of cost[i][t_i + 1]."""
    best = {0: (0.0, [])}
    for row in cost:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t, x in enumerate(row, start=-1):
                if used + t not in nxt or c + x < nxt[used + t][0]:
                    nxt[used + t] = (c + x, [*ts, t])
        best = nxt
    return best[total]


def search_plan(sample: np.ndarray, nodes: int, max_bits: int = MAX_BITS,
                probe_cost: float = 1000.0) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of least estimated cost; ``sample``: fingerprints as uint64."""
    bits = ((sample[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    best = None
    pairs = max(1, len(sample) * (len(sample) - 1) // 2)
    for m in range(1, max_bits + 2):
        parts = _groups(bits, m) if len(sample) else [list(range(i, 64, m)) for i in range(m)]
        cost = np.full((m, max_bits + 2), 0.0)
        for i, part in enumerate(parts):
            mask = np.uint64(sum(1 << b for b in part))
            near = np.zeros(max_bits + 1)
            for at in range(0, len(sample), 256):
                d = np.bitwise_count((sample[at:at + 256, None] ^ sample[None, :]) & mask)
                near += [(d <= t).sum() for t in range(max_bits + 1)]
            for t in range(max_bits + 1):
                ball = sum(comb(len(part), r) for r in range(t + 1))
                share = max((near[t] - len(sample)) / 2 / pairs, ball / 2.0 ** len(part))
                cost[i, t + 1] = probe_cost * nodes * ball + share * nodes * nodes / 2
        found = _allocate(cost, max_bits - m + 1)
        if best is None or found[0] < best[0]:
            best = (found[0], list(zip(parts, found[1])))
    return [(part, t) for part, t in best[1] if t >= 0]


# ------------------------------------------------------------------ probes and verification

def _gather(fps: np.ndarray, part: list[int]) -> np.ndarray:
    """The value of the partition's bits."""
    out = np.zeros(len(fps), np.uint64)
    for i, b in enumerate(part):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(i)
    return out


def _probes(plan: list[tuple[list[int], int]]):
    """Rows (p, v, fp): the node under every partition value within its threshold."""
    flips = [np.array([sum(1 << i for i in c) for r in range(t + 1)
                       for c in combinations(range(len(part)), r)], np.uint64) for part, t in plan]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fps = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
                for p, (part, _) in enumerate(plan):
                    values = (_gather(fps, part)[:, None] ^ flips[p][None, :]).view(np.int64)
                    for cut in range(0, values.shape[1], 256):
                        v = values[:, cut:cut + 256]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(v.size, p, np.int32)), pa.array(v.ravel()),
                             pa.array(np.repeat(fps.view(np.int64), v.shape[1]))],
                            names=["p", "v", "fp"])

    return run


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of a spanning forest: breadth first, over the nodes not reached yet."""
    links, left = [], fps
    while len(left) > 1:
        frontier, left = [left[:1]], left[1:]
        while frontier and len(left):
            wave = frontier.pop()
            for at in range(0, len(wave), 64):
                some = wave[at:at + 64]
                near = np.bitwise_count(some[:, None] ^ left[None, :]) <= max_bits
                hit = near.any(axis=0)
                if hit.any():
                    links.append((some[near[:, hit].argmax(axis=0)], left[hit]))
                    frontier.append(left[hit])
                    left = left[~hit]
    return links


def _verify(max_bits: int):
    """True links of each cell; rows arrive sorted by cell, which holds few nodes."""
    keys = 4

    def links(cols):
        key = np.stack(cols[:keys])
        fps = cols[keys].view(np.uint64)
        first = np.r_[0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1]
        size = np.diff(np.r_[first, len(fps)])
        group = np.repeat(np.arange(len(first)), size)
        few = np.repeat(size <= 16, size)
        g, f = group[few], fps[few]
        for s in range(1, 16):  # small cells: all at once, each row with the s-th after it
            near = (g[s:] == g[:-s]) & (np.bitwise_count(f[s:] ^ f[:-s]) <= max_bits)
            if near.any():
                yield f[:-s][near], f[s:][near]
        for i in np.flatnonzero(size > 16):
            yield from _forest(np.unique(fps[first[i]:first[i] + size[i]]), max_bits)

    def out(cols):
        for a, b in links(cols):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                             names=["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
                    for i in range(keys + 1)]
            cols = cols if held is None else [np.r_[x, y] for x, y in zip(held, cols)]
            if not len(cols[0]):
                continue
            # the last cell may go on in the next batch
            same = np.ones(len(cols[0]), bool)
            for c in cols[:keys]:
                same &= c == c[-1]
            at = len(same) - int(same[::-1].argmin()) if not same.all() else 0
            if at:
                yield from out([c[:at] for c in cols])
            held = [c[at:] for c in cols]
        if held is not None and len(held[0]):
            yield from out(held)

    return run


def near_links(nodes: DataFrame, max_bits: int = MAX_BITS, sample: int = 4096,
               cell: int = 4096) -> DataFrame:
    """(a, b): links that join all nodes ``fp`` (distinct longs) at ``max_bits`` or fewer bits."""
    picked = nodes.orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()
    plan = search_plan(np.array([r.fp for r in picked], np.int64).view(np.uint64),
                       nodes.count(), max_bits)
    probes = nodes.select("fp").mapInArrow(_probes(plan), "p int, v long, fp long")
    # Keys with over `cell` nodes (at most a row for each `cell` probes) are cut into blocks.
    hot = (probes.groupBy("p", "v").agg(F.count("*").alias("n")).where(F.col("n") > cell)
           .select(F.col("p").alias("hp"), F.col("v").alias("hv"),
                   F.ceil(F.col("n") / (cell // 2)).cast("int").alias("blocks")))
    dealt = (probes.join(hot, (F.col("p") == F.col("hp")) & (F.col("v") == F.col("hv")), "left")
             .withColumn("own", F.when(F.col("blocks").isNotNull(),
                                       F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")))
             .withColumn("other", F.explode(F.when(
                 F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(
                 F.sequence(F.lit(0), F.col("blocks") - 1))))
             .select("p", "v", F.coalesce(F.least("own", "other"), F.lit(0)).alias("ca"),
                     F.coalesce(F.greatest("own", "other"), F.lit(0)).alias("cb"), "fp"))
    cells = dealt.repartition("p", "v", "ca", "cb").sortWithinPartitions("p", "v", "ca", "cb")
    return cells.mapInArrow(_verify(max_bits), "a long, b long")


def fingerprint_components(prints: DataFrame, id_col: str, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of ``prints`` (id_col, fp)."""
    spark = prints.sparkSession
    path = scratch_path(spark, "simhash-nodes")
    prints.groupBy("fp").agg(F.min(id_col).alias("low")).write.parquet(path)
    nodes = spark.read.parquet(path)
    roots = components(near_links(nodes.select("fp"), max_bits))
    joined = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = joined.groupBy("root").agg(F.min("low").alias("component_id"))
    return joined.join(lows, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (long), component_id of every row."""
    path = scratch_path(docs.sparkSession, "simhash")
    with_fingerprints(docs, text_col, [F.col(id_col).alias("doc_id")], shingle).write.parquet(path)
    prints = docs.sparkSession.read.parquet(path)
    return prints.join(fingerprint_components(prints, "doc_id", max_bits), "fp").select(
        "doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of one document of each component: smallest id, then smallest hash of id and text.

    The columns stay as they are.  Rows repeated whole (id and text) leave one.
    """
    spark = docs.sparkSession
    # 128 bits: among very many rows a shorter hash would take two rows for one
    key = hash_key(0, F.col(id_col), F.md5(F.col(text_col).cast("binary")))
    path = scratch_path(spark, "simhash")
    with_fingerprints(docs, text_col, [F.col(id_col).alias("id"), key.alias("row")], shingle
                      ).write.parquet(path)
    prints = spark.read.parquet(path)
    of = fingerprint_components(prints, "id", max_bits)
    # each component's first row: the id (null last), then the row's hash
    mark = unused(docs, "row")
    first = (prints.join(of, "fp").groupBy("root")
             .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("x"))
             .select(F.col("x.row").alias(mark)).distinct())
    return docs.withColumn(mark, key).join(first, mark, "left_semi").dropDuplicates([mark]).drop(mark)
