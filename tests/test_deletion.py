from shroud import schemas
from shroud.operators import deletion


def _customers(spark, emails):
    rows = [tuple([str(i), e] + [None] * 16) for i, e in enumerate(emails)]
    return spark.createDataFrame(rows, schemas.CUSTOMERS)


def _reqs(spark, emails):
    return spark.createDataFrame([(e,) for e in emails], schemas.DELETIONS)


def test_parity_is_asymmetric(spark):
    c = _customers(spark, ["a@x.com", " b@x.com ", "C@x.com", None])
    r = _reqs(spark, ["A@X.COM", "b@x.com", "c@x.com", None])
    kept = {row["email"] for row in deletion.apply_deletions(c, r).collect()}
    # mixed-case source e-mail survives a lower-cased request in parity mode
    assert kept == {"C@x.com", None}


def test_strict_lowercases_both_sides_and_ignores_empty_requests(spark):
    c = _customers(spark, ["a@x.com", "C@x.com", "", None])
    r = _reqs(spark, ["c@x.com ", "  ", None])
    kept = {row["email"] for row in deletion.apply_deletions(c, r, strict=True).collect()}
    assert kept == {"a@x.com", "", None}


def test_delete_twice_is_once(spark):
    c = _customers(spark, [f"u{i}@x.com" for i in range(40)] + [None] * 20)
    r = _reqs(spark, [f"U{i}@X.com" for i in range(0, 40, 4)])
    once = deletion.apply_deletions(c, r)
    twice = deletion.apply_deletions(once, r)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert once.count() == 60 - 10


def test_input_is_distinct_skips_the_shuffle_and_agrees(spark):
    c = _customers(spark, [f"u{i}@x.com" for i in range(30)] + [None] * 5)
    r = _reqs(spark, [f"U{i}@X.com" for i in range(0, 30, 3)])
    full = deletion.apply_deletions(c, r, strict=True)
    fast = deletion.apply_deletions(c, r, strict=True, input_is_distinct=True)
    assert sorted(map(str, full.collect())) == sorted(map(str, fast.collect()))
    def customer_aggregates(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return [x for x in plan.split("\n") if "Aggregate" in x and "tracking_uuid" in x]

    assert customer_aggregates(full)           # the DISTINCT over customer rows...
    assert not customer_aggregates(fast)       # ...is gone
