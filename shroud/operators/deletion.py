"""Deletion requests: drop customers whose e-mail was asked to be forgotten."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import normalize_email
from ..schemas import CUSTOMER_COLUMNS
from .joins import keyed_join

REQ = "__request_email"


def request_keys(requests: DataFrame, strict: bool = False) -> DataFrame:
    """lower(trim(email)) of the requests, NULLs removed.

    Strict mode also drops requests that trim to '' (which would otherwise
    match every de-identified row, whose e-mail is '').  Exact copies are
    removed map-side by de-duplicating on (normalised, raw) e-mail; the join
    then shuffles on the normalised key alone, a plain exchange that AQE's
    skew handling can split (a DISTINCT on the join key itself would sit
    between that exchange and the join and hide it).
    """
    keys = (requests.select(normalize_email("email").alias(REQ), "email")
            .where(F.col(REQ).isNotNull()))
    if strict:
        keys = keys.where(F.col(REQ) != "")
    return keys.distinct().select(REQ)


def apply_deletions(customers: DataFrame, requests: DataFrame, strict: bool = False,
                    distinct_rows: Observation | None = None,
                    input_is_distinct: bool = False) -> DataFrame:
    """Distinct customers minus those named in ``requests``.

    Parity mode compares ``trim(email)`` of the customer with the normalised
    request, so a customer e-mail with capitals is *not* deleted by a
    lower-cased request; strict mode lower-cases both sides.  NULL e-mails
    are kept and spread over the shuffle; a hot e-mail on the customer side
    is split by AQE, and the request side is broadcast by AQE only when its
    measured size is under the broadcast threshold.  ``distinct_rows``
    (optional) counts the distinct customer rows inside the same plan.

    ``input_is_distinct=True`` skips the DISTINCT (a full shuffle of the
    widest table) for inputs known to hold no duplicate rows, such as the
    previous version written by this job; with a broadcast request side the
    deletion then needs no shuffle of the customers at all.
    """
    left = customers.select(*CUSTOMER_COLUMNS)
    if not input_is_distinct:
        left = left.distinct()
    if distinct_rows is not None:
        left = left.observe(distinct_rows, F.count(F.lit(1)).alias("rows"))
    key = normalize_email("email") if strict else F.trim("email")
    return keyed_join(left, request_keys(requests, strict), key, REQ, "left_anti",
                      CUSTOMER_COLUMNS)


def requested(customers: DataFrame, requests: DataFrame, strict: bool = False) -> DataFrame:
    """The rows of ``customers`` (any columns with ``email``) that ``apply_deletions`` would drop."""
    key = normalize_email("email") if strict else F.trim("email")
    return keyed_join(customers, request_keys(requests, strict), key, REQ, "left_semi", customers.columns)
