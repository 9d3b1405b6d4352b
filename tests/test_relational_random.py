"""Randomised edge cases for the identity and deletion joins against DuckDB.

Small tables are generated with the awkward cases together: NULL and padded
ids, duplicate rows, keys with several uuids or a NULL uuid, mixed-case and
padded e-mails, empty and NULL requests.  DuckDB runs the original SQL forms
(left join + IS NULL, DISTINCT after the join) on the same rows.
"""

import random

import duckdb
import pandas as pd
import pytest

from shroud import schemas
from shroud.operators import deletion, identity

SRC = "app"


def _tables(seed):
    rng = random.Random(seed)
    ids = [None, "", " 1", "1", "2", "3", "4 ", "5", "6", "7"]
    emails = [None, "", " ", "a@x.com", "A@x.com", " a@x.com ", "b@x.com", "B@X.COM", "c@x.com"]
    cust = []
    for _ in range(rng.randint(20, 60)):
        row = [rng.choice(ids), rng.choice(emails)] + [rng.choice([None, "v", "w"]) for _ in range(16)]
        cust.append(row)
        if rng.random() < 0.2:
            cust.append(list(row))                      # exact copy
    keys = [f"{SRC}-1", f" {SRC}-2 ", f"{SRC}-3", f"{SRC}- 1", f"{SRC}-4", f"{SRC}-", None, "other-5"]
    ids_rows = [(rng.choice(keys), rng.choice(["u1", "u2", "u3", None])) for _ in range(rng.randint(3, 15))]
    reqs = [(rng.choice(emails + ["A@X.COM ", "  b@x.com"]),) for _ in range(rng.randint(0, 8))]
    return cust, ids_rows, reqs


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _duck(con, sql):
    return sorted((tuple(r) for r in con.sql(sql).fetchall()), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_identity_and_deletion_joins_match_sql(spark, seed):
    cust, ids_rows, reqs = _tables(seed)
    c = spark.createDataFrame(cust, schemas.CUSTOMERS)
    s = spark.createDataFrame(ids_rows, schemas.IDENTITY)
    r = spark.createDataFrame(reqs, schemas.DELETIONS)
    con = duckdb.connect()
    src = pd.DataFrame(cust, columns=schemas.CUSTOMER_COLUMNS)
    idsvc = pd.DataFrame(ids_rows, columns=schemas.IDENTITY_COLUMNS)
    dels = pd.DataFrame(reqs, columns=["email"], dtype=object)
    con.register("src", src)
    con.register("idsvc", idsvc)
    con.register("dels", dels)
    on = f"trim(concat('{SRC}-', a.id)) = trim(b.sourceSystemId)"
    cols = ", ".join(schemas.CUSTOMER_COLUMNS)
    blanked = ", ".join(f"'' {x}" if x in schemas.PII_COLUMNS else x for x in schemas.CUSTOMER_COLUMNS)
    # DuckDB's concat() skips NULLs; Spark's returns NULL, as the original SQL engine did.
    on = on.replace(f"concat('{SRC}-', a.id)", f"('{SRC}-' || a.id)")

    assert _rows(identity.deidentify(c, s, SRC).drop("dtc")) == _duck(
        con, f"select distinct {blanked}, b.uuid gid from src a join idsvc b on {on}")
    assert _rows(identity.secure(c, s, SRC).drop("dtc")) == _duck(
        con, f"select distinct a.*, b.uuid gid from src a left join idsvc b on {on}")
    assert _rows(identity.missing_identities(c, s, SRC).drop("dtc")) == _duck(con, f"""
        select distinct '{SRC}' source, '{SRC}-' || a.id source_id, a.email, a.created_at
        from src a left join idsvc b on {on} where b.sourceSystemId is null""")
    assert _rows(deletion.apply_deletions(c, r)) == _duck(con, f"""
        select distinct a.* from (select distinct {cols} from src) a
        left join (select distinct email from dels) b on trim(a.email) = lower(trim(b.email))
        where lower(trim(b.email)) is null""")
    assert _rows(deletion.apply_deletions(c, r, strict=True)) == _duck(con, f"""
        select distinct a.* from (select distinct {cols} from src) a
        left join (select distinct lower(trim(email)) e from dels where lower(trim(email)) <> '') b
          on lower(trim(a.email)) = b.e
        where b.e is null""")
    pairs_rows = _tables(seed + 1000)[1] + ids_rows[: len(ids_rows) // 2]
    con.register("pairs", pd.DataFrame(pairs_rows, columns=schemas.IDENTITY_COLUMNS))
    pairs = spark.createDataFrame(pairs_rows, schemas.IDENTITY)
    assert _rows(identity.new_identity_pairs(pairs, s)) == _duck(con, """
        select distinct a.sourceSystemId, a.uuid from pairs a left join idsvc b
          on trim(a.sourceSystemId) = trim(b.sourceSystemId)
        where b.sourceSystemId is null""")
    j = identity.join_identities(c, s, SRC)
    assert _rows(identity.deidentified_from(j).drop("dtc")) == _rows(
        identity.deidentify(c, s, SRC).drop("dtc"))
    assert _rows(identity.missing_from(j, SRC).drop("dtc")) == _rows(
        identity.missing_identities(c, s, SRC).drop("dtc"))
