"""Gzip decoding for objects whose name does not say they are gzip.

The text file source picks its codec from the file suffix.  Sources whose
objects are always gzip-compressed may still name them without ``.gz``;
those objects are read as bytes and decoded here, in Arrow batches (the
decompression itself is zlib's C code).  Content that is not valid gzip or
not UTF-8 decodes to NULL, which the redaction quarantines.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf


BATCH_CHARS = 16 << 20


def gunzip_bytes(b: bytes) -> bytes | None:
    """The decompressed bytes, None where they are not gzip or not UTF-8."""
    try:
        out = gzip.decompress(b)
        out.decode("utf-8")
        return out
    except (OSError, EOFError, zlib.error, UnicodeDecodeError):
        return None


def _gunzip(b) -> str | None:
    out = None if b is None else gunzip_bytes(bytes(b))
    return None if out is None else out.decode("utf-8")


def _gunzip_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Texts in batches of about ``BATCH_CHARS``, whatever an input batch inflates to."""
    for content in batches:
        held, size = [], 0
        for b in content:
            held.append(_gunzip(b))
            size += len(held[-1] or "")
            if size >= BATCH_CHARS:
                yield pd.Series(held, dtype="object")
                held, size = [], 0
        if held:
            yield pd.Series(held, dtype="object")


def gunzip_text(content: Column | str) -> Column:
    """UTF-8 text of a gzip-compressed binary column (NULL when invalid).

    The UDF is built on the driver at call time; workers only import the
    plain functions above."""
    return pandas_udf(_gunzip_batches, "string")(content)
