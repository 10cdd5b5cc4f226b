"""The fused suite: every check can fail, tables are read once, rows equal those of the single checks."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martline.plans.checks import COUNT, Suite, groups, rows_where, total


def d(s):
    return dt.date.fromisoformat(s)


def rows(spark, suite, **tables):
    return {(r.check, r.table_name): (r.status, r.detail) for r in suite.rows(spark, tables).collect()}


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame([(d("2024-01-01"), "a", 2, 10.0), (d("2024-01-01"), "a", 1, 5.5), (d("2024-01-03"), None, 1, None), (None, None, 1, 1.0)],
                                 "date date, k string, n bigint, v double")


def test_every_verdict_fails_and_passes(spark, facts):
    days = spark.createDataFrame([(d("2024-01-01"),), (d("2024-01-02"),)], "date date")
    empty = facts.limit(0)
    hollow = facts.withColumn("gone", F.lit(None).cast("string"))
    suite = (Suite().dated(t="date", days="date", e="date", h="date")
             .exists("t", "e").grain("t", ("date", "k")).grain("days", ("date",)).grain("e", ("k",))
             .date_range("t", "days").date_range("days", "t").date_range("e", "days")
             .filled("t").filled("h", ()).filled("h", ("gone",)).filled("e", ("date", "k", "n"))
             .totals("good", ("t", total("v")), ("h", total("v"))).totals("bad", ("t", total("v")), ("t", total(F.col("v") + 1, "more")))
             .totals("none", ("t", total("v")), ("e", total("v")))
             .expected("seven", ("t", COUNT), ("days", COUNT), factor=2).expected("groups", ("days", COUNT), ("t", groups(("date", "k"))))
             .alignment("same", "t", "h", [("n", total("n"), total("n"))]).alignment("off", "t", "days", [("n", COUNT, COUNT)])
             .overlap("t", "t", "days", F.col("k") == "a").overlap("e", "t", "e", F.col("k") == "a"))
    got = rows(spark, suite, t=facts, days=days, e=empty, h=hollow)
    assert got["exists", "t"] == ("PASS", "non-empty") and got["exists", "e"] == ("FAIL", "empty")
    assert got["grain", "t"] == ("FAIL", "2") and got["grain", "days"] == ("PASS", "0") and got["grain", "e"] == ("PASS", "0")
    assert got["date_range", "t"] == ("FAIL", "2024-01-01..2024-01-03") and got["date_range", "days"][0] == "PASS" and got["date_range", "e"][0] == "FAIL"
    assert got["empty_columns", "t"] == ("PASS", "") and got["empty_columns", "e"] == ("FAIL", "v")
    assert got["reconcile", "good"] == ("PASS", "0.00") and got["reconcile", "bad"] == ("FAIL", "3.00") and got["reconcile", "none"][0] == "FAIL"
    assert got["expected_rows", "seven"] == ("PASS", "4/4") and got["expected_rows", "groups"] == ("FAIL", "2/3")
    assert got["alignment_n", "same"] == ("PASS", "0") and got["alignment_n", "off"] == ("FAIL", "4")
    assert got["overlap_removal", "t"] == ("PASS", "4-2=2") and got["overlap_removal", "e"] == ("FAIL", "4-2=0")


def test_empty_column_and_allow_list_of_one_table(spark, facts):
    hollow = facts.withColumn("gone", F.lit(None).cast("string")).withColumn("it's", F.lit(None).cast("int"))
    assert rows(spark, Suite().filled("h"), h=hollow)["empty_columns", "h"] == ("FAIL", "gone,it's")
    assert rows(spark, Suite().filled("h", ("gone", "it's")), h=hollow)["empty_columns", "h"] == ("PASS", "")


def test_two_key_sets_and_figures_of_rows(spark, facts):
    suite = Suite().grain("t", ("date", "k")).grain("t", ("n", "v")).expected("hit", ("t", rows_where("a", F.col("k") == "a")), ("t", groups(("k",))))
    got = [(r.check, r.status, r.detail) for r in suite.rows(spark, {"t": facts}).collect()]
    assert sorted(got) == [("expected_rows", "PASS", "2/2"), ("grain", "FAIL", "2"), ("grain", "PASS", "0")]


def test_day_check_needs_a_date_column(spark, facts):
    with pytest.raises(ValueError, match="no date column"):
        Suite().dated(days="date").date_range("t", "days").rows(spark, {"t": facts, "days": facts})


def test_exact_sums(spark):
    cents = spark.range(1000).select(F.lit(0.1).alias("v"))
    assert rows(spark, Suite().totals("x", ("a", total("v")), ("b", total("v"))), a=cents, b=spark.range(1).select(F.lit(100.0).alias("v")))["reconcile", "x"] == ("PASS", "0.00")


@pytest.mark.skipif(not os.path.exists(f"{SF_SMALL}/lineitem.parquet"), reason="no driver tables")
def test_fused_suite_equals_single_checks_and_writes_nothing(spark):
    from martline.registry import fused_suite, run_suite
    fused = fused_suite(spark, SF_SMALL)
    assert sorted(fused.collect()) == sorted(run_suite(spark, SF_SMALL).collect())
    assert "suite-" not in fused._jdf.queryExecution().executedPlan().toString()


def test_one_scan_per_table(spark, facts, tmp_path):
    path = str(tmp_path / "facts")
    facts.write.parquet(path)
    t = spark.read.parquet(path)
    suite = Suite().dated(t="date").exists("t").grain("t", ("date", "k")).date_range("t", "t").filled("t").totals("s", ("t", total("v")), ("t", total("n")))
    out = suite.rows(spark, {"t": t})
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    assert "Join" not in plan
