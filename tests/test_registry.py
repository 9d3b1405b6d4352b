"""Every query of the library against its DuckDB oracle on the smallest tables.

The optional training-data queries, not all of which SQL can express, have their own tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import digest, duck  # noqa: E402

from shroud.plans.catalog import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "gid" in df.columns and "dtc" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(ORACLES[name])
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(list(rel.columns), drows)[0]
