"""Toxicity by the nearest labelled examples.

Texts are TF-IDF vectors over terms: words, and word beginnings of 4 and 5 bytes (marked with
``*``).  The vocabulary is what a chi-square test on the examples ties to the rarer label; document
frequencies are counted over all documents.  The examples lie in an inverted index cut into
blocks: per block the postings, and per term and block the largest weight.  A query's cosine with
any example of a block is at most the sum of its terms' largest weights there, so blocks are
scored from the highest bound down until the bound falls below the k-th cosine: the neighbours
are exact.  Their labels vote with weight 1 / (1 - cosine + 0.05); the vote is calibrated by
isotonic regression on the examples' own votes (each left out of its neighbours).

The examples are a bounded sample of labelled rows: about ``EXAMPLES``, by a seeded hash, texts of
at most ``LONGEST`` bytes, copies and near copies (equal bottom-4 sketches) once.  The index goes
to every task, its size bound by ``EXAMPLES`` and ``TERMS``.  Scoring reads whole texts in one pass
without a shuffle.

Defined cases: a text without a vocabulary term (empty or null too) gets the share of label 1
among such examples.  Ties go to the smaller example number.  Without examples the score is 0.
A document with several label rows is one example for each distinct label.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, slices, words

EXAMPLES, LONGEST, TERMS, CHI_SQUARE, LEAST, BLOCK, NEIGHBOURS, SEED = 8000, 16384, 1024, 30.0, 4, 32, 25, 4


def term_counts(text: bytes, known=None) -> dict[bytes, int]:
    """Counts of the terms (of those in ``known``)."""
    out: dict[bytes, int] = {}
    for w, n in Counter(words(text)).items():
        for t in (w, w[:4] + b"*", w[:5] + b"*"):
            if known is None or t in known:
                out[t] = out.get(t, 0) + n
    return out


def _sketch(text: bytes) -> tuple:
    return tuple(sorted({xxhash.xxh64_intdigest(w) for w in words(text)})[:4])


def select_terms(texts: list[bytes], labels: np.ndarray) -> list[bytes]:
    """Terms tied to the rarer label, by chi-square, the strongest first."""
    n, ones = len(texts), int(labels.sum())
    if not ones or ones == n:
        return []
    rarer = int(2 * ones <= n)
    ones = min(ones, n - ones)
    seen, with_one = Counter(), Counter()
    for t, y in zip(texts, labels):
        if y == rarer:
            with_one.update(term_counts(t).keys())
    with_one = Counter({t: m for t, m in with_one.items() if m >= LEAST})
    for t in texts:
        seen.update(term_counts(t, with_one).keys())
    found = []
    for t, m in seen.items():
        if m >= LEAST:
            a, p = with_one[t], ones / n
            chi = (a - m * p) ** 2 / (m * p * (1 - p) * (1 - m / (n + 1)))
            if a > m * p and chi >= CHI_SQUARE:
                found.append((-chi, t))
    return [t for _, t in sorted(found)[:TERMS]]


class Index:
    """Block-max inverted index of the examples, the votes and their calibration."""

    def __init__(self, texts: list[bytes], labels: np.ndarray, ids: list, terms: list[bytes],
                 idf: np.ndarray):
        self.known = {t: i for i, t in enumerate(terms)}
        self.idf = idf
        rows = [self.vector(t) for t in texts]
        self.zero = [i for i, (t, _) in enumerate(rows) if not len(t)]
        # examples of like content share a block, which keeps the bounds tight
        some = sorted((i for i in range(len(rows)) if len(rows[i][0])),
                      key=lambda i: (rows[i][0][rows[i][1].argmax()], rows[i][0].tolist(), i))
        self.ids, self.labels = [ids[i] for i in some], labels[some].astype(float)
        self.none = (labels[self.zero].sum() + 0.5) / (len(self.zero) + 1) if len(texts) else 0.0
        blocks = -(-len(some) // BLOCK)
        self.top = np.zeros((blocks, len(terms)))
        at, post = np.zeros((blocks, len(terms) + 1), np.int64), []
        for b in range(blocks):
            own = sorted((t, i, w) for i in range(b * BLOCK, min(len(some), (b + 1) * BLOCK))
                         for t, w in zip(*(x.tolist() for x in rows[some[i]])))
            at[b, 1:] = np.bincount([t for t, _, _ in own], minlength=len(terms))
            at[b, 0] = len(post)
            post += own
            for t, _, w in own:
                self.top[b, t] = max(self.top[b, t], w)
        self.at = np.cumsum(at, axis=1)
        self.post_example = np.array([i for _, i, _ in post], np.int64)
        self.post_weight = np.array([w for _, _, w in post])
        votes = [(self.vote(*rows[i], leave_out=n)[0], self.labels[n]) for n, i in enumerate(some)]
        self.steps = _isotonic(votes)

    def vector(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and normalised TF-IDF weights."""
        counts = term_counts(text, self.known)
        t = np.array(sorted(self.known[x] for x in counts), np.int64)
        tf = {self.known[x]: n for x, n in counts.items()}
        w = np.array([1 + np.log(tf[i]) for i in t.tolist()]) * self.idf[t]
        return t, w / np.linalg.norm(w) if len(t) else w

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS,
                leave_out: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine above 0, exactly; and the cosines."""
        bound = self.top[:, terms] @ weights
        order = np.argsort(-bound, kind="stable")
        who, near = np.zeros(0, np.int64), np.zeros(0)
        for i in range(0, len(order), 8):
            some = order[i:i + 8]
            # the margin is for rounding; equal bounds are still scored, for ties
            some = some[(bound[some] > 0) & ((len(who) < k) | (bound[some] >= near[-1:].sum() - 1e-9))]
            if not len(some):
                break
            start, end = self.at[some][:, terms], self.at[some][:, terms + 1]
            size = (end - start).ravel()
            where = np.repeat(start.ravel() - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
            q = np.repeat(np.broadcast_to(weights, start.shape).ravel(), size)
            found, slot = np.unique(self.post_example[where], return_inverse=True)
            cosine = np.bincount(slot, self.post_weight[where] * q, len(found))
            who, near = np.r_[who, found], np.r_[near, np.round(cosine, 12)]
            best = np.lexsort((who, -near))
            best = best[who[best] != leave_out][:k]
            who, near = who[best], near[best]
        return who, near

    def vote(self, terms, weights, leave_out: int = -1):
        """(share of label 1 among the neighbours by weight, neighbours, cosines)."""
        if not len(terms):
            return None, (), ()
        who, near = self.nearest(terms, weights, leave_out=leave_out)
        if not len(who):
            return None, (), ()
        w = 1 / (1.05 - np.minimum(near, 1))
        return float(w @ self.labels[who] / w.sum()), who, near

    def score(self, text: bytes):
        """(calibrated score, ids of the three nearest examples, their cosines)."""
        raw, who, near = self.vote(*self.vector(text))
        if raw is None:
            return float(self.none), [], []
        level = int(np.searchsorted(self.steps[0], raw + 1e-9)) - 1
        return float(self.steps[1][max(level, 0)]), [self.ids[i] for i in who[:3]], list(map(float, near[:3]))


def _isotonic(votes: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps (from this vote on, this share) by pooling adjacent violators."""
    pools: list[list[float]] = []  # first vote, ones, rows
    by_vote: dict[float, list[float]] = {}
    for v, y in votes:
        if v is not None:
            p = by_vote.setdefault(round(v, 6), [0.0, 0.0])
            p[0] += y
            p[1] += 1
    for v in sorted(by_vote):
        pools.append([v, *by_vote[v]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, a, b = pools.pop()
            pools[-1][1] += a
            pools[-1][2] += b
    if not pools:
        return np.zeros(1), np.zeros(1)
    return (np.array([p[0] for p in pools]),
            np.maximum.accumulate([(p[1] + 0.5) / (p[2] + 1) for p in pools]))


# ------------------------------------------------------------------ on tables

def examples(docs: DataFrame, labels: DataFrame, learn: Column, *, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "toxic", most: int = EXAMPLES,
             longest: int = LONGEST, seed: int = SEED) -> list[tuple]:
    """(id, text bytes, label) of the bounded sample; ``learn`` is over the label table."""
    marked = (labels.where(learn & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
              .select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")).distinct())
    share = min(1.0, most / max(1, marked.count()))
    draw = F.pmod(F.xxhash64(F.lit(seed), "__id"), F.lit(1 << 30)) / (1 << 30)
    picked = F.broadcast(marked.where(draw < share))  # about `most` rows
    rows = (docs.where(F.octet_length(text_col) <= longest)
            .select(F.col(id_col).alias("__id"), F.col(text_col).cast("binary").alias("t"))
            .join(picked, "__id").limit(2 * most).collect())
    out, seen = [], set()
    for r in sorted(rows, key=lambda r: (r["__id"], r["__y"], bytes(r.t))):
        mark = (_sketch(bytes(r.t)), r["__y"])
        if mark not in seen:
            seen.add(mark)
            out.append((r["__id"], bytes(r.t), r["__y"]))
    return out


def document_frequency(docs: DataFrame, terms: list[bytes], text_col: str = "text") -> tuple[int, np.ndarray]:
    """Number of documents, and of those that hold each term, over all rows."""
    known = {t: i for i, t in enumerate(terms)}

    def run(batches):
        n, seen = 0, np.zeros(len(terms), np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                for t in as_bytes(part.column(0)).to_pylist():
                    n += 1
                    for x in term_counts(t, known):
                        seen[known[x]] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, len(terms)), pa.int32()), pa.array([n, *seen.tolist()], pa.int64())],
            names=["t", "n"])

    rows = docs.select(text_col).mapInArrow(run, "t int, n long").groupBy("t").agg(F.sum("n").alias("n"))
    n, seen = 0, np.zeros(len(terms), np.int64)
    for r in rows.collect():  # a row a term
        if r.t < 0:
            n = r.n
        else:
            seen[r.t] = r.n
    return n, seen


def train(docs: DataFrame, labels: DataFrame, learn: Column, *, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic", **sampling) -> Index:
    found = examples(docs, labels, learn, id_col=id_col, text_col=text_col, label_col=label_col, **sampling)
    y = np.array([r[2] for r in found], np.int64)
    texts = [r[1] for r in found]
    terms = select_terms(texts, y)
    n, seen = document_frequency(docs, terms, text_col)
    return Index(texts, y, [r[0] for r in found], terms, np.log(1 + n / np.maximum(seen, 1)))


def score(docs: DataFrame, index: Index, keep: list, text_col: str = "text") -> DataFrame:
    """The ``keep`` columns, score, evidence (ids of the nearest examples) and cosines."""
    at = len(keep)
    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = rows.drop("__text").withColumns({
        "score": F.lit(0.0), "evidence": F.array().cast("array<string>"),
        "cosines": F.array().cast("array<double>")}).schema

    def run(batches):
        for batch in batches:
            for part in slices(batch, at):
                s, who, near = zip(*map(index.score, as_bytes(part.column(at)).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:at], pa.array(s, pa.float64()),
                     pa.array([list(map(str, x)) for x in who], pa.list_(pa.string())),
                     pa.array(near, pa.list_(pa.float64()))], names=schema.names)

    return rows.mapInArrow(run, schema)
