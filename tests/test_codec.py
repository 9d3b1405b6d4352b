import gzip

import pandas as pd
from pyspark.sql import functions as F

from shroud.functions import codec


def test_inflated_batches_are_small_and_whole(monkeypatch):
    monkeypatch.setattr(codec, "BATCH_CHARS", 10)
    texts = ["abcd", "", None, "x" * 25, "efgh", "ij"]
    packed = pd.Series([None if t is None else gzip.compress(t.encode()) for t in texts])
    out = list(codec._gunzip_batches(iter([packed[:4], packed[4:], packed[:0]])))
    assert [t for s in out for t in s] == texts
    assert [len(s) for s in out] == [4, 2]
    assert list(next(codec._gunzip_batches(iter([packed[:1].map(lambda b: b[:9])])))) == [None]


def test_gunzip_keeps_rows_together(spark):
    rows = [(i, gzip.compress(f"text {i}".encode()) if i % 3 else b"not gzip") for i in range(500)]
    df = spark.createDataFrame(rows, "i int, content binary").select("i", codec.gunzip_text("content").alias("t"))
    assert df.where(~F.col("t").eqNullSafe(F.when(F.col("i") % 3 != 0, F.concat(F.lit("text "), "i")))).count() == 0
    assert df.count() == 500
