"""A hot non-NULL key on the big side is split by AQE's skew-join handling.

The plans keep a plain shuffle directly under each side of the sort-merge
join (no DISTINCT on the join key between them), which is what lets AQE
split a skewed partition.  Thresholds are lowered so that the effect shows on
test-sized data.
"""

import pytest
from pyspark.sql import functions as F

from shroud import schemas
from shroud.operators import deletion, identity

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "32",
}


@pytest.fixture()
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _customers(spark, n, id_col, email_col, extra=None):
    extra = extra or {}
    return spark.range(n).select(*[
        (id_col if c == "id" else email_col if c == "email" else
         extra.get(c, F.lit(None).cast("string"))).alias(c)
        for c in schemas.CUSTOMER_COLUMNS])


def _final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_hot_email_split_in_deletion(skew_session):
    spark = skew_session
    n = 300000
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot@x.com")).otherwise(
        F.concat(F.col("id").cast("string"), F.lit("@x.com")))
    cust = _customers(spark, n, F.col("id").cast("string"), hot)
    req = spark.range(0, n, 7).select(F.concat(F.col("id").cast("string"), F.lit("@X.com")).alias("email"))
    rows, plan = _final_plan(deletion.apply_deletions(cust, req, strict=True))
    assert "SortMergeJoin(skew=true)" in plan
    expected = n - len([i for i in range(0, n, 7) if i % 3 != 0])
    assert len(rows) == expected


def test_hot_id_split_in_audit(skew_session):
    spark = skew_session
    n = 300000
    ids = F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.col("id").cast("string"))
    cust = _customers(spark, n, ids, F.concat(F.col("id").cast("string"), F.lit("@x.com")))
    idsvc = spark.range(0, n, 2).select(F.concat(F.lit("app-"), F.col("id").cast("string")).alias("sourceSystemId"),
                                        F.col("id").cast("string").alias("uuid"))
    rows, plan = _final_plan(identity.missing_identities(cust, idsvc, "app"))
    assert "SortMergeJoin(skew=true)" in plan
    missing = len([i for i in range(n) if i % 3 != 0 and i % 2 == 1]) + len(range(0, n, 3))
    assert len(rows) == missing


@pytest.mark.parametrize("op", ["deidentify", "secure"])
def test_hot_id_split_in_identity_joins(skew_session, op):
    spark = skew_session
    n = 300000
    # a third of the rows carry the same id; they stay distinct rows after PII
    # blanking because a non-PII column differs
    ids = F.when(F.col("id") % 3 == 0, F.lit("8")).otherwise(F.col("id").cast("string"))
    cust = _customers(spark, n, ids, F.concat(F.col("id").cast("string"), F.lit("@x.com")),
                      {"tracking_uuid": F.col("id").cast("string")})
    idsvc = spark.range(0, n, 2).select(F.concat(F.lit("app-"), F.col("id").cast("string")).alias("sourceSystemId"),
                                        F.col("id").cast("string").alias("uuid"))
    fn = identity.deidentify if op == "deidentify" else identity.secure
    rows, plan = _final_plan(fn(cust, idsvc, "app"))
    assert "SortMergeJoin(skew=true)" in plan
    if op == "secure":
        assert len(rows) == n
    else:
        matched = len([i for i in range(n) if i % 3 != 0 and i % 2 == 0]) + len(range(0, n, 3))
        assert len(rows) == matched
