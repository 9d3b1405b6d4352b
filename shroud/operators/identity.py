"""Identity-service joins: de-identify, secured copy, missing-identity audit,
new identity pairs, uniqueness, completeness and upsert.

Plan shape (checked with ``explain``): each input is de-duplicated *before*
its join shuffle, so map-side partial aggregation collapses exact copies of
a row (a single group of copies can be a third of the table) before any
data moves; the de-duplicated sides are then hash-partitioned once on the
trimmed key.  The result needs no second DISTINCT because a distinct left
side joined to a distinct (key, uuid) right side is itself distinct.

The identity side is de-duplicated on (key, uuid), never on the key alone:
the join then keeps its own exchange on the key, which is what lets AQE
split a hot key on the customer side.  ``join_identities`` performs the one
join from which the de-identify job derives all three outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import run_stamp, source_id, source_key
from ..schemas import CUSTOMER_COLUMNS, PII_COLUMNS
from ..sources.identity_service import read_keys, write_identity_index
from .joins import keyed_join

KEY = "__idsvc_key"


def identity_lookup(idsvc: DataFrame) -> DataFrame:
    """(trimmed key, uuid) pairs of the identity service, distinct, no NULL keys."""
    return (idsvc.select(F.trim("sourceSystemId").alias(KEY), "uuid")
            .where(F.col(KEY).isNotNull())
            .distinct())


def blank_pii(customers: DataFrame) -> DataFrame:
    """Blank the PII columns to '' (not NULL); keep the others, in order."""
    return customers.select(*[F.lit("").alias(c) if c in PII_COLUMNS else F.col(c)
                              for c in CUSTOMER_COLUMNS])


def deidentify(customers: DataFrame, idsvc: DataFrame, source: str,
               as_of: str | None = None) -> DataFrame:
    """De-identified customers: PII blanked, ``gid`` = identity uuid, ``dtc`` stamp.

    Inner join: customers without an identity are dropped (they go to the
    audit instead).  Blanking happens before the DISTINCT, so the PII
    columns are never read from the scan.
    """
    left = blank_pii(customers).distinct()
    out = keyed_join(left, identity_lookup(idsvc), source_key("id", source), KEY, "inner", [])
    return out.select(*CUSTOMER_COLUMNS, F.col("uuid").alias("gid"),
                      run_stamp(as_of).alias("dtc"))


def secure(customers: DataFrame, idsvc: DataFrame, source: str,
           as_of: str | None = None, distinct_rows: Observation | None = None) -> DataFrame:
    """Secured copy: every distinct raw customer row plus ``gid`` (NULL when unknown).

    ``distinct_rows`` (optional) counts the distinct customer rows inside the
    same plan, so reconciling needs no extra pass over the input."""
    left = customers.select(*CUSTOMER_COLUMNS).distinct()
    if distinct_rows is not None:
        left = left.observe(distinct_rows, F.count(F.lit(1)).alias("rows"))
    out = keyed_join(left, identity_lookup(idsvc), source_key("id", source), KEY, "left",
                     CUSTOMER_COLUMNS)
    return out.select(*CUSTOMER_COLUMNS, F.col("uuid").alias("gid"),
                      run_stamp(as_of).alias("dtc"))


def missing_identities(customers: DataFrame, idsvc: DataFrame, source: str,
                       as_of: str | None = None) -> DataFrame:
    """Audit rows for customers the identity service does not know.

    Only (id, email, created_at) are read; distinct first, anti-join second.
    """
    left = customers.select("id", "email", "created_at").distinct()
    # (key, uuid) pairs are already distinct; a second DISTINCT on the key alone
    # would hide the join's exchange from AQE's skew-join splitting.
    keys = identity_lookup(idsvc).select(KEY)
    out = keyed_join(left, keys, source_key("id", source), KEY, "left_anti",
                     ["id", "email", "created_at"])
    return out.select(F.lit(source).alias("source"),
                      source_id("id", source).alias("source_id"),
                      "email", "created_at", run_stamp(as_of).alias("dtc"))


def new_identity_pairs(pairs: DataFrame, idsvc: DataFrame) -> DataFrame:
    """Distinct (sourceSystemId, uuid) pairs whose trimmed key is not in the service."""
    left = pairs.select("sourceSystemId", "uuid").distinct()
    keys = identity_lookup(idsvc).select(KEY)
    return keyed_join(left, keys, F.trim("sourceSystemId"), KEY, "left_anti",
                      ["sourceSystemId", "uuid"])


def unique_identities(idsvc: DataFrame) -> DataFrame:
    """One uuid per raw key; the smallest wins so reruns agree (partial agg, skew-safe)."""
    return idsvc.groupBy("sourceSystemId").agg(F.min("uuid").alias("uuid"))


def upsert_identities(existing: DataFrame, new_pairs: DataFrame) -> DataFrame:
    """Identity table after putting ``new_pairs`` by raw key: a new pair
    replaces an existing row with the same key; among several new pairs for
    one key the smallest uuid wins."""
    fresh = new_pairs.where(F.col("sourceSystemId").isNotNull())
    incoming = unique_identities(fresh)
    # replaced keys, de-duplicated on (key, uuid) so the join keeps its own,
    # skew-splittable exchange on the key
    replaced = fresh.select(F.col("sourceSystemId").alias(KEY), "uuid").distinct().select(KEY)
    kept = keyed_join(existing.select("sourceSystemId", "uuid"), replaced,
                      F.col("sourceSystemId"), KEY, "left_anti", ["sourceSystemId", "uuid"])
    return kept.unionByName(incoming)


def lookup_gids(keys: DataFrame, idsvc: DataFrame, key_col: str = "source_id") -> DataFrame:
    """Batch point lookup: every distinct key with its uuid(s) or NULL."""
    left = keys.select(key_col).distinct()
    out = keyed_join(left, identity_lookup(idsvc), F.trim(key_col), KEY, "left", [key_col])
    return out.select(key_col, F.col("uuid").alias("gid"))


def write_lookup_index(idsvc: DataFrame, path: str, **layout) -> None:
    """The identity lookup as a table in key order with Bloom filters (see ``write_identity_index``)."""
    write_identity_index(identity_lookup(idsvc), path, KEY, **layout)


def lookup_gids_indexed(keys: DataFrame, index_path: str, key_col: str = "source_id",
                        at_most: int = 2000) -> DataFrame:
    """``lookup_gids`` on an indexed table; the same rows for a batch of any size.

    Up to ``at_most`` distinct keys are read by predicates that prune row groups; the driver holds
    no more of them.  A larger batch is joined with the whole table.
    """
    spark = keys.sparkSession
    index = spark.read.parquet(index_path)
    left = keys.select(key_col).distinct()
    batch = [r[0] for r in left.select(F.trim(key_col).alias(KEY)).where(F.col(KEY).isNotNull())
             .distinct().limit(at_most + 1).collect()]
    if len(batch) <= at_most:
        index = read_keys(index, KEY, sorted(batch))
    out = keyed_join(left, index, F.trim(key_col), KEY, "left", [key_col])
    return out.select(key_col, F.col("uuid").alias("gid"))


def completeness(idsvc: DataFrame, expected_rows: int) -> DataFrame:
    """One-row reconciliation of a lookup snapshot against the row count the
    store reports; ``complete`` is true once every expected row was read."""
    return (idsvc.agg(F.count(F.lit(1)).alias("rows_read"),
                      F.count_distinct("sourceSystemId").alias("distinct_keys"))
            .withColumn("expected_rows", F.lit(int(expected_rows)).cast("long"))
            .withColumn("complete", F.col("rows_read") >= F.col("expected_rows")))


# ---------------------------------------------------------------------------
# One join for all three outputs (used by the de-identify job).
MATCHED = "__matched"


def join_identities(customers: DataFrame, idsvc: DataFrame, source: str,
                    distinct_rows: Observation | None = None) -> DataFrame:
    """Distinct customers left-joined to the identity lookup, once.

    Returns the customer columns, ``uuid`` and ``__matched`` (true when the
    key was found, NULL otherwise; a stored NULL uuid still counts as found).
    The secured copy, the de-identified copy and the audit rows all derive
    from this one frame (``secured_from``, ``deidentified_from``,
    ``missing_from``) with the same results as ``secure``, ``deidentify``
    and ``missing_identities``.
    """
    left = customers.select(*CUSTOMER_COLUMNS).distinct()
    if distinct_rows is not None:
        left = left.observe(distinct_rows, F.count(F.lit(1)).alias("rows"))
    right = identity_lookup(idsvc).withColumn(MATCHED, F.lit(True))
    out = keyed_join(left, right, source_key("id", source), KEY, "left", CUSTOMER_COLUMNS)
    return out.select(*CUSTOMER_COLUMNS, "uuid", MATCHED)


def secured_from(joined: DataFrame, as_of: str | None = None) -> DataFrame:
    return joined.select(*CUSTOMER_COLUMNS, F.col("uuid").alias("gid"),
                         run_stamp(as_of).alias("dtc"))


def deidentified_from(joined: DataFrame, as_of: str | None = None) -> DataFrame:
    """Matched rows with PII blanked; blanking can make rows equal, hence DISTINCT
    (map-side first, over the non-PII columns only)."""
    rows = joined.where(F.col(MATCHED)).select(
        *[F.lit("").alias(c) if c in PII_COLUMNS else F.col(c) for c in CUSTOMER_COLUMNS],
        F.col("uuid").alias("gid"))
    return rows.distinct().withColumn("dtc", run_stamp(as_of))


def missing_from(joined: DataFrame, source: str, as_of: str | None = None) -> DataFrame:
    rows = joined.where(F.col(MATCHED).isNull()).select("id", "email", "created_at").distinct()
    return rows.select(F.lit(source).alias("source"), source_id("id", source).alias("source_id"),
                       "email", "created_at", run_stamp(as_of).alias("dtc"))
