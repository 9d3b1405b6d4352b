"""Plan properties the design relies on: pushdown, pruning, join shape."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from shroud.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def no_static_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_deidentify_prunes_and_pushes_down(no_static_broadcast):
    plan = _plan(E.queries()["deidentify_customers"](no_static_broadcast, SF))
    assert "SortMergeJoin Inner" in plan
    # identity side: only the key and the filtered column are read, filter in the scan
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThanOrEqual(c_acctbal,0.0)]" in plan


def test_deletion_pushes_request_filter(no_static_broadcast):
    plan = _plan(E.queries()["delete_requested"](no_static_broadcast, SF))
    assert "SortMergeJoin LeftAnti" in plan
    assert "EqualTo(c_mktsegment,BUILDING)" in plan


def test_masking_is_a_single_scan_projection(spark):
    plan = _plan(E.queries()["mask_text_documents"](spark, SF))
    assert "Exchange" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonUDF")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_registered_plans(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert not [n for n in PYTHON_NODES if n in plan]


@pytest.mark.parametrize("name", ["json_redact_clickstream", "json_redact_chat", "json_redact_orders",
                                  "json_redact_service"])
def test_each_document_is_parsed_once(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # the document, and the redacted text that the query takes apart; never again in a filter
    assert plan.count("parseJson") == 2
    assert not any("Filter" in line and "parseJson" in line for line in plan.splitlines())
