"""Helpers shared by the training-data operators: words, batches, hash order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java/DuckDB class of a word: ASCII digits and lower-case letters, and all that is not ASCII.
WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_word_bytes = bytearray(b" " * 128 + bytes(range(128, 256)))
_lower_bytes = bytearray(range(256))
for _a, _b in zip(_UPPER.encode(), _LOWER.encode()):
    _word_bytes[_a] = _word_bytes[_b] = _lower_bytes[_a] = _b
for _a in b"0123456789":
    _word_bytes[_a] = _a
WORD_BYTES, LOWER_BYTES = bytes(_word_bytes), bytes(_lower_bytes)


def words(text: bytes) -> list[bytes]:
    """The words (``WORD_CLASS``) of the text with A-Z in lower case."""
    return text.translate(WORD_BYTES).split()


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; other letters stay (``lower`` would change them)."""
    return F.translate(c, _UPPER, _LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(column: pa.Array) -> pa.Array:
    """A text column as UTF-8 bytes; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return pc.fill_null(column.cast(kind), b"")


def slices(batch: pa.RecordBatch, text: int, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose texts hold at most ``limit`` bytes, one row at least."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.binary_length(as_bytes(batch.column(text))).to_numpy(zero_copy_only=False))
    start, base = 0, 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(start, end - start)
        start, base = end, int(ends[end - 1])


def hash_key(seed: int, *columns: Column) -> Column:
    """A seeded order of rows that any engine can repeat: 32 hex digits."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)),
                             *(F.coalesce(c.cast("string"), F.lit("null")) for c in columns)))


def digits_for(rows: int, per_bucket: int = 20_000) -> int:
    """Leading hex digits of a hash key that deal ``rows`` into buckets of about ``per_bucket``."""
    d = 2
    while rows > per_bucket * 16 ** d and d < 7:
        d += 1
    return d


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name
