"""Language identification by nearest centroid over character n-grams.

Text becomes a normalised TF-IDF vector of hashed letter bigrams and trigrams (runs of other
characters are one boundary).  Each language has several centroids, clustered by spherical
k-means, as one language holds several styles.  A text gets the language of the centroid of
highest cosine, and is rejected if that cosine is less than half of what all but one in a hundred
training texts of its length reach.

The centroids are fit on a bounded sample of labelled rows: about ``PER_LANG`` a language and
``MOST`` at most in all, chosen by a seeded hash of the text among texts of every length.  Their n-grams are
counted in the tasks, whole texts, and only the counts (``DIMS`` a text at most) reach the driver.  The
first words of the sampled texts tell how near short texts come, for the rejection of such.  Document
frequencies are counted over all rows that may be learnt from, whole texts, in one pass.  The
model is the only thing that is sent to the tasks and its size is fixed by ``DIMS`` and the number
of centroids.  Prediction reads whole texts, in one pass without a shuffle.

Defined cases: text null or without a letter: ``und``, score 0, rejected.  No training row at
all: every text is ``und``.  Ties go to the language that sorts first.  Repeated rows and other
columns make no difference.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

DIMS, PER_LANG, MOST, CENTROIDS, SEED = 8192, 1000, 8000, 4, 8


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter, and at 0x110000 False."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None, dims: int = DIMS) -> np.ndarray | None:
    """Counts of the hashed n-grams; None without a letter."""
    if not text:
        return None
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[code]
    if not is_letter.any():
        return None
    line = np.zeros(len(code) + 2, np.uint64)
    line[1:-1] = np.where(is_letter, code, 0)
    keep = line > 0
    keep[1:] |= keep[:-1].copy()
    keep[0] = True
    line = line[keep]
    counts = np.zeros(dims, np.int64)
    for at in range(0, len(line), 1 << 20):
        x = line[at:at + (1 << 20) + 2]
        two = x[:-1] * np.uint64(0x9E3779B97F4A7C15) + x[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        three = two[:-1] * np.uint64(0x165667B19E3779F9) + x[2:] * np.uint64(0x27D4EB2F165667C5)
        two = two[:1 << 20]  # the overlap of two symbols belongs to the next part
        for h in (two, three[:1 << 20]):
            counts += np.bincount((h >> np.uint64(40)).astype(np.int64) % dims, minlength=dims)
    return counts


class Model:
    def __init__(self, idf, centroids, langs, floor):
        self.idf, self.centroids, self.langs, self.floor = idf, centroids, langs, floor

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected)."""
        counts = gram_counts(text, len(self.idf))
        if counts is None or not len(self.langs):
            return "und", 0.0, True
        at = np.flatnonzero(counts)
        v = (1 + np.log(counts[at])) * self.idf[at]
        cosine = (v / max(np.linalg.norm(v), 1e-12)) @ self.centroids[at]
        best = int(cosine.argmax())
        score = float(min(1.0, max(0.0, cosine[best])))
        return self.langs[best], score, score < self.floor[int(counts.sum()).bit_length()]


def _clusters(x: np.ndarray, k: int, rng: np.random.RandomState) -> np.ndarray:
    """Spherical k-means from seeds that are far apart."""
    c = x[[rng.randint(len(x))]]
    while len(c) < min(k, len(x)):
        c = np.vstack([c, x[(x @ c.T).max(axis=1).argmin()]])
    for _ in range(12):
        own = (x @ c.T).argmax(axis=1)
        c = np.vstack([x[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def fit(samples: list[tuple], frequency: tuple[int, np.ndarray], pieces: list[tuple] = (),
        centroids: int = CENTROIDS, seed: int = SEED) -> Model:
    """A model of (language, n-gram buckets, counts) samples; ``frequency``: texts, and texts with each n-gram;
    ``pieces``: samples that only tell how near short texts come."""
    total, seen = frequency
    dims = len(seen)
    idf = np.log((1 + total) / (1 + seen)) + 1

    def rows(some: list) -> np.ndarray:  # of one language, so a bounded part of the sample
        x = np.zeros((len(some), dims), np.float32)
        for i, (_, at, n) in enumerate(some):
            x[i, at] = (1 + np.log(n)) * idf[at]
            x[i] /= max(np.linalg.norm(x[i]), 1e-12)
        return x

    rng, made, names, reach = np.random.RandomState(seed), [], [], {}
    for lang in sorted({r[0] for r in samples}):
        own = [r for r in samples if r[0] == lang]
        x = rows(own)
        c = _clusters(x, centroids, rng)
        made.append(c)
        names += [lang] * len(c)
        near = [(x @ c.T).max(axis=1)]
        del x
        short = [r for r in pieces if r[0] == lang]
        near = np.concatenate(near + [(rows(short[i:i + 128]) @ c.T).max(axis=1) for i in range(0, len(short), 128)])
        for (*_, n), cosine in zip(own + short, near):
            reach.setdefault(int(n.sum()).bit_length(), []).append(float(cosine))
    # longer texts have higher cosines; sizes with few samples take the size below, the smallest the first
    filled = [size for size in range(65) if len(reach.get(size, [])) >= 10]
    # a few odd texts of a size do not set its floor
    low = {size: float(np.quantile(reach[size], 0.01)) / 2 for size in filled}
    floor, least = np.zeros(65), low[filled[0]] if filled else 0.0
    for size in range(65):
        least = low.get(size, least)
        floor[size] = least
    return Model(idf, np.vstack(made).T.astype(np.float64) if made else np.zeros((dims, 0)), names, floor)


def document_frequency(docs: DataFrame, learn: Column, *, text_col: str = "text",
                       lang_col: str = "lang", dims: int = DIMS) -> tuple[int, np.ndarray]:
    """Number of labelled texts with a letter, and of those that hold each n-gram, over all rows."""
    def run(batches):
        n, seen = 0, np.zeros(dims, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                for t in part.column(0).to_pylist():
                    counts = gram_counts(t, dims)
                    if counts is not None:
                        n += 1
                        seen += counts > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, dims), pa.int32()), pa.array([n, *seen.tolist()], pa.int64())],
            names=["gram", "n"])

    rows = (docs.where(learn & F.col(lang_col).isNotNull()).select(text_col)
            .mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")))
    n, seen = 0, np.zeros(dims, np.int64)
    for r in rows.collect():  # a row an n-gram bucket
        if r.gram < 0:
            n = r.n
        else:
            seen[r.gram] = r.n
    return n, seen


def _first_words(text: str) -> list[str]:
    """Its first 1, 2, 4 and 8 words, where there are more."""
    words = text.split(None, 9)
    return [" ".join(words[:n]) for n in (1, 2, 4, 8) if n < len(words)]


def sample(docs: DataFrame, learn: Column, *, text_col: str = "text", lang_col: str = "lang",
           per_lang: int = PER_LANG, most: int = MOST, seed: int = SEED, dims: int = DIMS
           ) -> tuple[list[tuple], list[tuple]]:
    """The bounded training sample, and pieces of its texts: (language, n-gram buckets, counts).

    Texts of any length are counted whole, where they lie; a sample is at most ``dims`` numbers.  Equal
    texts of a language are drawn, and taken, once."""
    # whoever has the same text has the same draw, so copies do not thin out a language
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(text_col)), F.lit(1 << 30)) / (1 << 30)
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), draw.alias("draw"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n")).collect()
    if not counts:
        return [], []
    quota = min(per_lang, max(1, most // len(counts)))
    share = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], min(1.0, quota / max(1, r["n"])))))

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                out = []
                for lang, text, at in zip(*(c.to_pylist() for c in part.columns)):
                    for nth, piece in enumerate([text, *_first_words(text)]):
                        n = gram_counts(piece, dims)
                        if n is not None:
                            found = np.stack([np.flatnonzero(n), np.minimum(n[n > 0], 2 ** 31 - 1)])
                            out.append((lang, at, nth, zlib.compress(found.astype(np.int32).tobytes(), 1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 4, (
                        pa.string(), pa.float64(), pa.int32(), pa.binary()))],
                    names=["lang", "draw", "nth", "grams"])

    picked = (rows.where(F.col("draw") < share[F.col("lang")])
              .mapInArrow(run, "lang string, draw double, nth int, grams binary")
              .dropDuplicates(["lang", "draw", "nth"]))
    kept = []
    for whole, limit in ((F.col("nth") == 0, most), (F.col("nth") > 0, most // 4)):
        found = picked.where(whole).orderBy("draw", "lang", "nth").limit(limit).collect()
        kept.append([(r.lang, *np.frombuffer(zlib.decompress(r.grams), np.int32).reshape(2, -1)) for r in found])
    return kept[0], kept[1]


def train(docs: DataFrame, learn: Column, *, text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of the rows that ``learn`` holds for."""
    frequency = document_frequency(docs, learn, text_col=text_col, lang_col=lang_col)
    found, pieces = sample(docs, learn, text_col=text_col, lang_col=lang_col)
    return fit(found, frequency, pieces)


def identify(docs: DataFrame, model: Model, keep: list, text_col: str = "text") -> DataFrame:
    """The ``keep`` columns, lang_pred, score and rejected of every row."""
    at = len(keep)
    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = rows.drop("__text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0),
                                              "rejected": F.lit(False)}).schema

    def run(batches):
        for batch in batches:
            for part in slices(batch, at):
                lang, score, out = zip(*map(model.predict, part.column(at).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:at], pa.array(lang), pa.array(score), pa.array(out)],
                    names=schema.names)

    return rows.mapInArrow(run, schema)


def drop_rejected(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose language is recognised, all columns as they are."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in slices(batch, at):
                yield part.filter(pa.array([not model.predict(t)[2] for t in part.column(at).to_pylist()]))

    return docs.mapInArrow(run, docs.schema)
