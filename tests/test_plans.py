"""Plan lint: properties every registered query's physical plan must keep at scale."""

import os
import re

import pytest

from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF_SMALL}/lineitem.parquet"), reason="no driver tables")

import __spark_entry__ as entry  # noqa: E402

from martline import registry  # noqa: E402

QUERIES = {n: q for n, q in entry.queries().items() if n in registry.QUERIES}
# nested-loop joins whose build side is bounded by construction: a constant
# terms table, or one row (a grand total, the list of label lengths, a table's
# own totals; their constant key folds away)
BOUNDED_NESTED_LOOP = {"geo_terms", "geo_summary", "sentiment_shares", "kpi_table", "campaign_linkage", "inventory"}


def plan_of(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # an adaptive plan that already ran prints its final and its initial plan
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_and_bounded_nested_loops(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan
    # everything stays in the JVM: no Python UDF or pandas operator in any plan
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in plan, (name, node)
    if "BroadcastNestedLoopJoin" in plan:
        assert name in BOUNDED_NESTED_LOOP, name


def test_flagship_scan_is_pruned(spark):
    plan = QUERIES["ecommerce_daily"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan) or re.findall(r"struct<(l_[^>]*)>", plan)
    li = [s for s in schemas if "l_orderkey" in s]
    assert li and all("l_tax" not in s and "l_returnflag" not in s for s in li)


@pytest.mark.parametrize("name,table,expected", [("paid_social_union", "lineitem.parquet", 1),
                                                 ("web_events_dedup", "events.parquet", 1)])
def test_extracts_read_in_one_scan(spark, name, table, expected):
    plan = plan_of(spark, name)
    assert plan.count(table) == expected, plan
