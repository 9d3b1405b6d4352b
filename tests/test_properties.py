"""Property checks: the Spark maskers against a reference-semantics oracle.

The oracle applies the original (backtracking) patterns with Python's
``re`` in ASCII mode, whose ``\\s`` equals Java's.  Spark uses the linear
e-mail form, so equal outputs confirm the two patterns match the same text.
"""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from shroud.functions import text as T

ALPHABET = "ab.@ -_()xy019\t\nAZé!,"
EMAIL = re.compile(T.EMAIL_PATTERN, re.ASCII)
PHONE = re.compile(T.PHONE_PATTERN, re.ASCII)
NAME = re.compile(T.NAME_PATTERN, re.ASCII)


def oracle(s: str) -> str:
    s = EMAIL.sub(T.TEXT_TOKEN, s)
    s = PHONE.sub(T.TEXT_TOKEN, s)
    return NAME.sub(T.TEXT_TOKEN, s)


texts = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=200, max_size=200)


@settings(max_examples=3, deadline=None)
@given(texts)
def test_mask_text_matches_backtracking_oracle(spark, batch):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(batch)], "i int, t string")
    got = {r["i"]: r["m"] for r in df.select("i", T.mask_text("t").alias("m")).collect()}
    for i, s in enumerate(batch):
        assert got[i] == oracle(s), (s, got[i], oracle(s))


@settings(max_examples=3, deadline=None)
@given(texts)
def test_linear_email_equals_original(spark, batch):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(batch)], "i int, t string")
    got = {r["i"]: r["m"] for r in df.select("i", T.mask_email("t").alias("m")).collect()}
    for i, s in enumerate(batch):
        assert got[i] == EMAIL.sub(T.TEXT_TOKEN, s), s
