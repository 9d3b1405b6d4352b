"""Benchmark decontamination with an FM-index over each training shard.

A shard is the slice of a task's documents that fits ``SHARD`` symbols; its symbols are words.
Test phrases (windows of ``width`` consecutive item words; a shorter item is one window) are
looked for by backward search: each step narrows the suffix-array range of all windows at once by
ranks in a wavelet tree (stored as a wavelet matrix) over the Burrows-Wheeler transform.  The
occurrences in a range are located by stepping back to the next sampled suffix position, and
overlapping ones merge into removal spans.

Words that no phrase holds cannot lie in an occurrence: they become separators, and stretches
between separators that are shorter than the shortest window are left out of the index.  A
document longer than a shard is indexed in pieces that overlap by ``width`` - 1 words.  Nothing
is shuffled.  Phrases go to the tasks in blocks of at most ``BLOCK`` bytes of item text; each
further block is one more pass over the documents in the same tasks.

Defined cases: null or empty text has no words, no spans.  Items with null id or without words
take no part; items of one id count once, whatever their texts.  Repeated rows each get their
result.  Empty tables: no row, or no hit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, slices, unused, words

WIDTH, SHARD, SAMPLE, BLOCK = 10, 1 << 20, 16, 4 << 20
SPANS = T.ArrayType(T.ArrayType(T.LongType()))


# ------------------------------------------------------------------ FM-index

def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes by prefix doubling; every separator (0) is a symbol of its own."""
    n = len(text)
    gaps = text == 0
    rank = text.astype(np.int64) + int(gaps.sum())
    rank[gaps] = np.arange(int(gaps.sum()))
    step = 1
    while True:
        follow = np.zeros(n, np.int64)
        follow[:n - step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + follow
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.cumsum(np.r_[0, key[1:] != key[:-1]])
        if fresh[-1] == n - 1:
            return order
        rank[order] = fresh
        step *= 2


class FMIndex:
    """Backward search over a text of symbols 1..sigma with 0 as separator (the last symbol)."""

    def __init__(self, text: np.ndarray, sigma: int):
        order = suffix_array(text)
        self.bwt = text[order - 1]
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=sigma + 2))].astype(np.int64)
        # a suffix after a separator is always sampled: steps back never cross one
        marked = (order % SAMPLE == 0) | (self.bwt == 0)
        self.marked, self.nth = marked, np.cumsum(marked) - 1
        self.position = order[marked]
        self.levels, row = [], self.bwt
        for bit in range(max(1, int(sigma).bit_length()) - 1, -1, -1):
            one = (row >> bit) & 1 == 1
            zeros = np.r_[0, np.cumsum(~one)].astype(np.int32)
            self.levels.append((bit, zeros))
            row = np.concatenate([row[~one], row[one]])
        every = np.arange(sigma + 2)
        self.begin = self._walk(every, np.zeros(len(every), np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, zeros in self.levels:
            z = zeros[at]
            at = np.where((symbol >> bit) & 1 == 1, zeros[-1] + at - z, z)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before row ``at`` of the transform."""
        return self._walk(symbol, at) - self.begin[symbol]

    def search(self, backward: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the patterns, given last symbol first and padded."""
        low, high = self.first[backward[:, 0]], self.first[backward[:, 0] + 1]
        for i in range(1, backward.shape[1]):
            live = np.flatnonzero((low < high) & (length > i))
            if not len(live):
                break
            c = backward[live, i]
            low[live] = self.first[c] + self.rank(c, low[live])
            high[live] = self.first[c] + self.rank(c, high[live])
        return low, high

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes at the given rows."""
        out, back, open_ = np.zeros(len(row), np.int64), 0, np.arange(len(row))
        while len(open_):
            known = self.marked[row]
            out[open_[known]] = self.position[self.nth[row[known]]] + back
            open_, row = open_[~known], row[~known]
            c = self.bwt[row]
            row = self.first[c] + self.rank(c, row)
            back += 1
        return out


# ------------------------------------------------------------------ phrases and search

class Phrases:
    """The windows of a block of items: word numbers, patterns and the items of each pattern."""

    def __init__(self, items: list[tuple], width: int):
        self.names = sorted({str(i) for i, _ in items})
        number = {x: n for n, x in enumerate(self.names)}
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple, set[int]] = {}
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            for at in range(max(1, len(ids) - width + 1) if ids else 0):
                windows.setdefault(tuple(ids[at:at + width]), set()).add(number[str(name)])
        self.width = width
        self.length = np.array([len(w) for w in windows], np.int64)
        self.backward = np.zeros((len(windows), width), np.int32)
        for i, w in enumerate(windows):
            self.backward[i, :len(w)] = w[::-1]
        self.of_start = np.r_[0, np.cumsum([len(x) for x in windows.values()])].astype(np.int64)
        self.of_item = np.array([i for x in windows.values() for i in sorted(x)], np.int64)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each range."""
    total = int(size.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.repeat(start - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(total)


def _pieces(text: np.ndarray, shard: int, overlap: int) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a shard's size that end at a separator, or overlap where there is none."""
    gaps, at = np.flatnonzero(text == 0), 0
    while at < len(text):
        end = min(at + shard, len(text))
        nxt = end
        if end < len(text):
            i = int(np.searchsorted(gaps, end)) - 1
            if i >= 0 and gaps[i] > at:
                nxt = end = int(gaps[i]) + 1
            else:
                nxt = end - overlap
        part = text[at:end]
        yield at, part if part[-1] == 0 else np.r_[part, 0]
        at = nxt


def search(texts: list[bytes], phrases: Phrases, shard: int = SHARD):
    """Per text: number of words, merged spans [start, end) in words, names of the items found."""
    get = phrases.vocabulary.get
    flat: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        w = words(t)
        counts[i] = len(w)
        flat += [get(x, 0) for x in w]
        flat.append(0)
    starts = np.r_[0, np.cumsum(counts + 1)]
    symbols = np.array(flat, np.int64)
    del flat
    cover = np.zeros(len(symbols) + 1, np.int64)
    found: list[np.ndarray] = []
    names = len(phrases.names)
    if len(phrases.length) and len(texts):
        # stretches of known words, at least as long as the shortest window, each with its separator
        edge = np.flatnonzero(np.diff(np.r_[0, symbols != 0, 0]))
        begin, end = edge[::2], edge[1::2]
        long_ = end - begin >= phrases.length.min()
        origin = _ranges(begin[long_], end[long_] - begin[long_] + 1)
        text = symbols[origin]
        for base, part in _pieces(text, max(shard, 2 * phrases.width), phrases.width - 1):
            index = FMIndex(part, len(phrases.vocabulary))
            low, high = index.search(phrases.backward, phrases.length)
            hit = np.flatnonzero(low < high)
            size = (high - low)[hit]
            which = np.repeat(hit, size)
            at = origin[base + index.locate(_ranges(low[hit], size))]
            np.add.at(cover, at, 1)
            np.add.at(cover, at + phrases.length[which], -1)
            doc = np.searchsorted(starts, at, "right") - 1
            n = np.diff(phrases.of_start)[which]
            item = phrases.of_item[_ranges(phrases.of_start[which], n)]
            found.append(np.unique(np.repeat(doc, n) * names + item))
    hits = np.cumsum(cover)[:-1] > 0
    edge = np.flatnonzero(np.diff(np.r_[0, hits, 0]))
    spans: list[list[list[int]]] = [[] for _ in texts]
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        doc = int(np.searchsorted(starts, a, "right")) - 1
        spans[doc].append([a - int(starts[doc]), b - int(starts[doc])])
    items: list[list[str]] = [[] for _ in texts]
    if found:
        for pair in np.unique(np.concatenate(found)).tolist():
            items[pair // names].append(phrases.names[pair % names])
    return counts, spans, items


def merge_spans(a: list, b: list) -> list:
    out: list[list[int]] = []
    for s, e in sorted([*map(list, a), *map(list, b)]):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def phrase_blocks(items: DataFrame, id_col: str, text_col: str, width: int,
                  limit: int = BLOCK) -> Iterator[Phrases]:
    """The items in blocks of bounded size, streamed to the driver a partition at a time."""
    rows = items.select(F.col(id_col).alias("i"), F.col(text_col).cast("binary").alias("t")).where(
        "i is not null and t is not null")
    held, size = [], 0
    for r in rows.toLocalIterator():
        if held and size + len(r.t) > limit:
            yield Phrases(held, width)
            held, size = [], 0
        held.append((r.i, bytes(r.t)))
        size += len(r.t)
    yield Phrases(held, width)


# ------------------------------------------------------------------ on tables

def find_leaks(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, spans (merged, [start, end) in words) and items (names) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.lit(0).cast("long").alias("n_words"),
                       F.array().cast(SPANS).alias("spans"),
                       F.array().cast("array<string>").alias("items"))
    schema = rows.schema

    def search_with(phrases: Phrases):
        def run(batches):
            for batch in batches:
                for part in slices(batch, 1):
                    n, spans, names = search(as_bytes(part.column(1)).to_pylist(), phrases)
                    spans = [merge_spans(a, b) if a else b for a, b in zip(part.column(3).to_pylist(), spans)]
                    names = [sorted({*a, *b}) for a, b in zip(part.column(4).to_pylist(), names)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array(n, pa.int64()),
                         pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                         pa.array(names, pa.list_(pa.string()))], names=schema.names)
        return run

    for phrases in phrase_blocks(items, item_col, item_text, width):
        rows = rows.mapInArrow(search_with(phrases), schema)
    return rows.drop("text")


def drop_leaks(docs: DataFrame, items: DataFrame, *, text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", width: int = WIDTH) -> DataFrame:
    """The rows without any removal span, all columns as they are."""
    at = docs.columns.index(text_col)

    def clean(phrases: Phrases):
        def run(batches):
            for batch in batches:
                for part in slices(batch, at):
                    _, spans, _ = search(as_bytes(part.column(at)).to_pylist(), phrases)
                    yield part.filter(pa.array([not s for s in spans], pa.bool_()))
        return run

    for phrases in phrase_blocks(items, item_col, item_text, width):
        docs = docs.mapInArrow(clean(phrases), docs.schema)
    return docs


def cut_spans(docs: DataFrame, items: DataFrame, *, text_col: str = "text",
              item_col: str = "item_id", item_text: str = "text", width: int = WIDTH) -> DataFrame:
    """All rows, with the words of the removal spans cut out of the text (what lies between
    words of a span goes too)."""
    # a word before A-Z become lower case
    word, at = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), docs.columns.index(text_col)

    def keep(text: str, spans) -> str:
        edges = [m.span() for m in word.finditer(text)]
        out, last = [], 0
        for s, e in spans:
            out.append(text[last:edges[s][0]])
            last = edges[e - 1][1]
        return "".join([*out, text[last:]])

    # the spans of all blocks are found in the uncut text, merged and cut once
    spans_col = unused(docs, "spans")
    rows = docs.withColumn(spans_col, F.array().cast(SPANS))
    schema, names = rows.schema, docs.columns

    def add(phrases: Phrases):
        def run(batches):
            for batch in batches:
                for part in slices(batch, at):
                    _, found, _ = search(as_bytes(part.column(at)).to_pylist(), phrases)
                    held = part.column(part.num_columns - 1).to_pylist()
                    spans = pa.array([merge_spans(a, b) if a else b for a, b in zip(held, found)],
                                     pa.list_(pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], spans], names=schema.names)
        return run

    def cut(batches):
        for batch in batches:
            for part in slices(batch, at):
                new = [keep(t, s) if s else t
                       for t, s in zip(part.column(at).to_pylist(), part.column(part.num_columns - 1).to_pylist())]
                out = part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type))
                yield pa.RecordBatch.from_arrays(out.columns[:-1], names=names)

    for phrases in phrase_blocks(items, item_col, item_text, width):
        rows = rows.mapInArrow(add(phrases), schema)
    return rows.mapInArrow(cut, docs.schema)
