from shroud import schemas
from shroud.operators import identity

SRC = "app"


def _customers(spark, rows):
    full = [tuple(list(r) + [None] * (18 - len(r))) for r in rows]
    return spark.createDataFrame(full, schemas.CUSTOMERS)


def _idsvc(spark, rows):
    return spark.createDataFrame(rows, schemas.IDENTITY)


def test_deidentify_blanks_pii_and_joins_trimmed_keys(spark):
    c = _customers(spark, [("1", "a@x.com", "t0", "t1", "Ann", "Lee", "555"),
                           ("2", "b@x.com"), (None, "n@x.com")])
    s = _idsvc(spark, [(" app-1 ", "g1"), ("app-9", "g9")])
    out = identity.deidentify(c, s, SRC, "2024-01-01").collect()
    assert len(out) == 1
    r = out[0]
    assert r["id"] == "1" and r["gid"] == "g1" and r["dtc"] == "2024-01-01 12:00:00"
    assert all(r[c] == "" for c in schemas.PII_COLUMNS)
    assert r["created_at"] == "t0"


def test_secured_keeps_unmatched_and_null_ids(spark):
    c = _customers(spark, [("1", "a"), ("2", "b"), (None, "n"), (None, "n")])
    s = _idsvc(spark, [("app-1", "g1")])
    out = {(r["id"], r["gid"]) for r in identity.secure(c, s, SRC).collect()}
    assert out == {("1", "g1"), ("2", None), (None, None)}


def test_missing_identities_many_null_ids(spark):
    # A third of the rows share the NULL key: still every one survives, once.
    rows = [("1", "a")] + [(None, f"n{i}@x") for i in range(300)] + [(str(i), f"e{i}") for i in range(2, 600)]
    c = _customers(spark, rows)
    s = _idsvc(spark, [(f"app-{i}", f"g{i}") for i in range(1, 600, 2)])
    out = identity.missing_identities(c, s, SRC, "2024-01-01")
    got = out.collect()
    assert len(got) == 300 + len([i for i in range(2, 600) if i % 2 == 0])
    assert sum(1 for r in got if r["source_id"] is None) == 300


def test_deidentify_and_audit_cover_all_ids(spark):
    c = _customers(spark, [(str(i), f"e{i}") for i in range(50)])
    s = _idsvc(spark, [(f"app-{i}", f"g{i}") for i in range(0, 50, 3)])
    pub = {r["id"] for r in identity.deidentify(c, s, SRC).collect()}
    aud = {r["source_id"] for r in identity.missing_identities(c, s, SRC).collect()}
    assert pub | {a.split("-", 1)[1] for a in aud} == {str(i) for i in range(50)}
    assert not pub & {a.split("-", 1)[1] for a in aud}


def test_new_pairs_and_upsert_idempotent(spark):
    s = _idsvc(spark, [("app-1", "g1"), (" app-2", "g2")])
    pairs = _idsvc(spark, [("app-1", "x"), ("app-2 ", "y"), ("app-3", "b"), ("app-3", "a"),
                           ("app-3", "a"), (None, "z")])
    new = identity.new_identity_pairs(pairs, s)
    assert {tuple(r) for r in new.collect()} == {("app-3", "b"), ("app-3", "a"), (None, "z")}
    once = identity.upsert_identities(s, new)
    assert {tuple(r) for r in once.collect()} == {("app-1", "g1"), (" app-2", "g2"), ("app-3", "a")}
    twice = identity.upsert_identities(once, identity.new_identity_pairs(pairs, once))
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_completeness(spark):
    s = _idsvc(spark, [("a", "1"), ("a", "2"), ("b", "3")])
    r = identity.completeness(s, 4).first()
    assert (r["rows_read"], r["distinct_keys"], r["complete"]) == (3, 2, False)
    assert identity.completeness(s, 3).first()["complete"] is True
