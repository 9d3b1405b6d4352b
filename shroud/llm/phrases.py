"""Phrase collocations by dynamic itemset counting.

The documents are cut into ``shards`` shards, scanned in turn, again and again.  Words are counted
from the first scan on.  A phrase of k words is activated once both its subphrases of k - 1 words
(all but the last, all but the first) have reached the threshold in what was scanned so far; it is
counted from the next scan on for exactly one full cycle of shards, so phrases of all lengths are
counted in the same scans and every count is exact.  The work ends when nothing was activated for
a full cycle.  Phrases that end their cycle below the threshold are dropped.

Scans count 64-bit hashes of phrases, so a count is the phrase's own or, where two share a hash, more;
none is lost.  A scan must know which subphrases have reached the threshold.  It is told by a table of
``slots`` bytes, the step at which a hash of this slot first reached it.  Phrases that share a slot only
start some counting early, but none before its subphrases are counted: the start follows from the table,
the same in every scan, so what is counted still gets one full cycle.  A last cycle counts by text, exactly, what the hashes have left: the phrases
whose slot, and whose parts' slots, hold a hash that ended at the threshold or above.  Those two tables
are all that goes to the tasks or the driver, of fixed size; slots beyond use cost work, never rows.
Counts are summed in each slice of texts, then by Spark before and after the shuffle, so a language or
word that holds most rows is no hot key.

Text: A-Z become lower case, pieces end at ``[.,;:!?\\x0A-\\x0D]``, words are ``[^\\x20\\x09]+`` of a piece.
Everything is per language (null: ``und``, together with a language of that name).  A candidate has
2 to ``longest`` words and a count a of ``least`` or more.  Cutting it into a first and a last part with
counts l and r gives ``floor(2000000 a / (l + r))``; the lowest cut counts (ties: the shortest first
part).  Dropped are candidates within a longer one that has ``within`` per cent of their count.
Arithmetic is in decimals of 38 digits.

Defined cases: a null text is empty; texts without words add nothing (a language without words has
no row); repeated rows count each time; a text is read in stretches that end between pieces, so only
one endless piece is held as a whole.  Empty table: no row.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import remove_path, scratch_path
from .common import as_bytes

LEAST, LONGEST, SHARDS, SLOTS, WITHIN, FIRST = 30, 4, 2, 1 << 24, 80, 2000
SLICE, BATCH, UNSET = 8 << 20, 1 << 16, 255
SCHEMA = "h long, mark int, n long"  # mark: first step * 8 + number of words

_END = b"\xff"  # ends a piece; no byte of UTF-8
_table = bytearray(range(256))
for _a in range(65, 91):
    _table[_a] = _a + 32
for _a in b".,;:!?\x0a\x0b\x0c\x0d":
    _table[_a] = 255
_PLAIN = bytes(_table)


def _stretches(texts: Iterator[tuple[str, bytes]], limit: int) -> Iterator[dict[str, list[bytes]]]:
    """Texts by language, about ``limit`` bytes at a time, long ones cut between pieces."""
    held, size = {}, 0
    for lang, text in texts:
        text = text.translate(_PLAIN)
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > limit - size:
                cut = text.rfind(_END, at, at + limit - size)
                if cut < 0 and not size:  # one piece is longer than a slice
                    cut = text.find(_END, at)
                if cut >= 0:
                    end = cut + 1
                elif size:
                    yield held
                    held, size = {}, 0
                    continue
            held.setdefault(lang, []).append(text[at:end])
            size += end - at
            at = end
            if size >= limit:
                yield held
                held, size = {}, 0
    if held:
        yield held


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


class Stretch:
    """Texts of one language as word numbers (0 ends a piece) and word hashes."""

    def __init__(self, lang: str, texts: list[bytes]):
        raw = np.frombuffer(_END.join(texts), np.uint8)
        letter = (raw != 32) & (raw != 9) & (raw != 255)
        begins = letter.copy()
        begins[1:] &= ~letter[:-1]
        # the words one after the other, without what stands between them
        at = np.flatnonzero(begins)
        ends = np.r_[np.flatnonzero(begins[letter]), letter.sum()].astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(raw[letter])])
        coded = words.dictionary_encode()
        piece = np.searchsorted(np.flatnonzero(raw == 255), at)
        place = np.arange(len(at)) + np.r_[0, np.cumsum(piece[1:] != piece[:-1])][:len(at)]
        self.x = np.zeros(int(place[-1]) + 1 if len(at) else 0, np.int64)
        self.x[place] = coded.indices.to_numpy().astype(np.int64) + 1
        self.vocabulary = pa.concat_arrays([pa.array([_END], pa.binary()), coded.dictionary])
        seed = xxhash.xxh64_intdigest(lang.encode())
        self.hash = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.vocabulary.to_pylist()),
                                np.uint64, len(self.vocabulary))
        self.count = np.bincount(self.x, minlength=len(self.vocabulary))
        self.count[0] = 0

    def active(self, reached: np.ndarray, step: int, shards: int, longest: int) -> Iterator[tuple]:
        """(k, hashes, first step of each, counts) of the active phrases of each length."""
        x, mask = self.x, np.uint64(len(reached) - 1)
        if step < shards:
            at = np.flatnonzero(self.count)
            yield 1, self.hash[at], np.zeros(len(at), np.int64), self.count[at]
        # of the phrase of the length before that begins at each place: its hash and the step it reached
        hashes, when = self.hash[x], reached[self.hash & mask]
        when[0] = UNSET
        when = when[x]
        for k in range(2, longest + 1):
            at = np.flatnonzero((when[:-1] < step) & (when[1:] < step))
            if not len(at):
                return
            act = np.maximum(when[at], when[at + 1]).astype(np.int64) + 1
            mixed = _mix(hashes[at], self.hash[x[at + k - 1]])
            now = step < act + shards
            if now.any():
                yield k, *_grouped(mixed[now], act[now])
            hashes, when = np.zeros(len(hashes) - 1, np.uint64), np.full(len(hashes) - 1, UNSET, np.uint8)
            # a slot that another hash reached early says nothing of steps before the phrase itself was counted
            hashes[at], when[at] = mixed, np.maximum(reached[mixed & mask], (act - 1).astype(np.uint8))

    def phrases(self, wanted: np.ndarray, longest: int) -> Iterator[tuple]:
        """(k, phrases, counts) of all phrases whose slot, and whose parts' slots, are wanted."""
        x, mask, size = self.x, np.uint64(len(wanted) - 1), len(self.vocabulary)
        large = wanted[self.hash & mask]
        large[0] = False
        at = np.flatnonzero(large & (self.count > 0))
        yield 1, self.vocabulary.take(pa.array(at)), self.count[at]
        hashes, large = self.hash[x], large[x]
        for k in range(2, longest + 1):
            at = np.flatnonzero(large[:-1] & large[1:])
            if not len(at):
                return
            mixed = _mix(hashes[at], self.hash[x[at + k - 1]])
            ok = wanted[mixed & mask]
            at, mixed = at[ok], mixed[ok]
            key = x[at]
            for j in range(1, k):  # equal words, told by their numbers; renumbered so that they fit 64 bits
                key = (np.unique(key, return_inverse=True)[1] if j > 1 else key) * size + x[at + j]
            _, one, n = np.unique(key, return_index=True, return_counts=True)
            words = [self.vocabulary.take(pa.array(x[at[one] + j])) for j in range(k)]
            yield k, pc.binary_join_element_wise(*words, b" "), n
            hashes, large = np.zeros(len(hashes) - 1, np.uint64), np.zeros(len(hashes) - 1, bool)
            hashes[at], large[at] = mixed, True


def _grouped(hashes: np.ndarray, act: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, act, count) of the distinct (hash, act)."""
    coded = pa.array(hashes).dictionary_encode()
    own, kinds = coded.indices.to_numpy(), len(coded.dictionary)
    first = np.zeros(kinds, np.int64)
    first[own] = act
    if (first[own] != act).any():  # two phrases of one hash that begin at different steps
        pairs, n = np.unique(np.rec.fromarrays([hashes, act]), return_counts=True)
        return pairs.f0, pairs.f1, n
    return coded.dictionary.to_numpy(), first, np.bincount(own, minlength=kinds)


def _texts(batches) -> Iterator[tuple[str, bytes]]:
    for b in batches:
        yield from zip(b.column(0).to_pylist(), as_bytes(b.column(1)).to_pylist())


def _scan(step: int, shards: int, longest: int, packed: bytes, limit: int):
    """Task function: (lang, text) rows to the counts of what is active in this step."""
    def run(batches):
        reached = np.frombuffer(zlib.decompress(packed), np.uint8)
        for held in _stretches(_texts(batches), limit):
            for lang, some in held.items():
                for k, h, act, n in Stretch(lang, some).active(reached, step, shards, longest):
                    out = pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array((act * 8 + k).astype(np.int32)), pa.array(n)],
                        names=["h", "mark", "n"])
                    for at in range(0, out.num_rows, BATCH):
                        yield out.slice(at, BATCH)

    return run


def _recount(longest: int, packed: bytes, limit: int):
    """Task function: (lang, text) rows to the counts of the wanted phrases; k = 0: of all words."""
    def run(batches):
        wanted = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8)).astype(bool)
        for held in _stretches(_texts(batches), limit):
            for lang, some in held.items():
                own = Stretch(lang, some)
                total = (0, pa.nulls(1, pa.binary()), np.array([own.count.sum()]))
                for k, phrase, n in (total, *own.phrases(wanted, longest)):
                    out = pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(n), pa.string()), phrase.cast(pa.string()),
                         pa.array(np.full(len(n), k, np.int32)), pa.array(n.astype(np.int64))],
                        names=["lang", "phrase", "k", "n"])
                    for at in range(0, out.num_rows, BATCH):
                        yield out.slice(at, BATCH)

    return run


def _new_slots(rows: DataFrame, slots: int) -> np.ndarray:
    """Which slots the rows take, as a bitmap that Spark puts together (slots / 8 bytes)."""
    slot = F.col("h").bitwiseAND(slots - 1)
    parts = (rows.groupBy(F.shiftright(slot, 15).alias("b"))
             .agg(F.bitmap_construct_agg(slot.bitwiseAND(32767)).alias("bits")))
    found = np.zeros(slots, bool)
    for r in parts.collect():  # 4 KiB for 32,768 slots
        found[r.b << 15:(r.b + 1) << 15] = np.unpackbits(np.frombuffer(bytes(r.bits), np.uint8), bitorder="little")
    return found


def count_phrases(spark: SparkSession, docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
                  least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, slots: int = SLOTS,
                  limit: int = SLICE) -> DataFrame:
    """lang, phrase, k, n: every phrase of 1 to ``longest`` words with ``least`` or more occurrences,
    and per language a row of k = 0 with the number of all words."""
    if slots & (slots - 1) or slots < 32768 or not 0 < shards * longest < UNSET or longest > 7:
        raise ValueError("slots: a power of 2, 32768 at least; longest: at most 7; shards * longest: below 255")
    corpus = scratch_path(spark, "phrases-shards")
    (docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                 F.col(text_col).cast("string").alias("text"),
                 # rows in turn: a group of copies spreads over the shards
                 F.pmod(F.monotonically_increasing_id(), F.lit(shards)).alias("shard"))
     .where("text is not null").write.partitionBy("shard").parquet(corpus))
    texts = spark.read.schema("lang string, text string, shard int").parquet(corpus)
    reached, wanted = np.full(slots, UNSET, np.uint8), np.zeros(slots, bool)
    words, act = F.col("mark").bitwiseAND(7), F.shiftright("mark", 3)
    step, last, waiting, before = 0, -1, None, None
    while step <= max(shards - 1, last + shards):
        counted = texts.where(F.col("shard") == step % shards).select("lang", "text").mapInArrow(
            _scan(step, shards, longest, zlib.compress(reached.tobytes(), 1), limit), SCHEMA)
        if waiting is not None:
            counted = counted.unionByName(waiting)
        at = scratch_path(spark, "phrases-step")
        ended = act + shards - 1 <= step
        (counted.groupBy("h", "mark").agg(F.sum("n").alias("n")).where(~ended | (F.col("n") >= least))
         .withColumn("ended", ended).write.partitionBy("ended").parquet(at))
        rows = spark.read.schema(f"{SCHEMA}, ended boolean").parquet(at)
        large = rows.where(F.col("n") >= least)
        fresh = _new_slots(large.where(words < longest), slots) & (reached == UNSET)
        if fresh.any():
            reached[fresh], last = step, step
        wanted |= _new_slots(large.where("ended"), slots)
        if before is not None:
            remove_path(spark, before)  # what waited has been carried over, what ended is in the table
        waiting, before, step = rows.where("not ended").drop("ended"), at, step + 1
    counts = (texts.select("lang", "text")
              .mapInArrow(_recount(longest, zlib.compress(np.packbits(wanted).tobytes(), 1), limit),
                          "lang string, phrase string, k int, n long")
              .groupBy("lang", "phrase", "k").agg(F.sum("n").alias("n"))
              .where((F.col("n") >= least) | (F.col("k") == 0)))
    at = scratch_path(spark, "phrases")
    counts.write.parquet(at)
    for path in (before, corpus):
        remove_path(spark, path)
    return spark.read.parquet(at)


def collocations(spark: SparkSession, counts: DataFrame, *, within: int = WITHIN, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``first`` collocations of each language."""
    known = counts.where("k > 0").select(F.col("lang").alias("pl"), F.col("phrase").alias("part"), F.col("n").alias("m"))
    found = counts.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))

    def words(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cut = found.withColumn("c", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cut = cut.withColumns({"head": words(F.lit(1), F.col("c")), "tail": words(F.col("c") + 1, F.col("k") - F.col("c"))})
    for end, name in (("head", "l"), ("tail", "r")):
        cut = (cut.join(known, (F.col("lang") == F.col("pl")) & (F.col(end) == F.col("part")))
               .withColumnRenamed("m", name).drop("pl", "part"))
    score = F.expr("cast((cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))) "
                   "div (cast(l as decimal(19,0)) + cast(r as decimal(19,0))) as long)")
    best = (cut.withColumn("score", score).groupBy("lang", "phrase")
            .agg(F.min(F.struct("score", "c", "l", "r", "a")).alias("b"))
            .select("lang", "phrase", "b.score", "b.l", "b.r", "b.a"))
    # (start, length) of the shorter candidates within a longer one
    spans = F.expr("flatten(transform(sequence(2, k - 1), z -> transform(sequence(1, k - z + 1), s -> struct(s, z))))")
    inner = (found.where("k > 2").withColumn("s", F.explode(spans))
             .select(F.col("lang").alias("il"), words(F.col("s.s"), F.col("s.z")).alias("ip"), "a")
             .groupBy("il", "ip").agg(F.max("a").alias("longer")))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    covered = 100 * big("longer") >= within * big("a")
    best = (best.join(inner, (F.col("lang") == F.col("il")) & (F.col("phrase") == F.col("ip")), "left")
            .where(~F.coalesce(covered, F.lit(False))).drop("il", "ip", "longer"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # one language may hold nearly all: the first of each part, then the first of those
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    some = best.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= first)
    some = (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= first))
    total = counts.where("k = 0").select(F.col("lang").alias("tl"), "n")
    return (some.join(total, F.col("lang") == F.col("tl"))
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def mine_collocations(spark: SparkSession, docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
                      least: int = LEAST, longest: int = LONGEST, within: int = WITHIN, first: int = FIRST,
                      **counting) -> DataFrame:
    """The collocations of the documents (see the module)."""
    counts = count_phrases(spark, docs, text_col=text_col, lang_col=lang_col, least=least, longest=longest, **counting)
    return collocations(spark, counts, within=within, first=first)
