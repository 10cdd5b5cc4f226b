"""Negative tests: every data-quality check must be able to FAIL."""

import datetime as dt

from pyspark.sql import functions as F

from martline.plans import quality as dq


def d(s):
    return dt.date.fromisoformat(s)


def status(df):
    return {(r.check, r.table_name): (r.status, r.detail) for r in df.collect()}


def test_grain_counts_all_members_and_nulls_equal(spark):
    t = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k int, v string")
    got = status(dq.check_grain({"t": (t, ["k", "v"]), "u": (t.where("k = 3"), ["k"])}))
    assert got[("grain", "t")] == ("FAIL", "4")
    assert got[("grain", "u")] == ("PASS", "0")


def test_date_range_out_of_bounds_fails(spark):
    t = spark.createDataFrame([(d("2023-01-01"),), (d("2024-07-01"),)], "date date")
    bounds = spark.createDataFrame([(d("2023-01-01"), d("2024-06-30"))], "s date, e date")
    got = status(dq.check_date_range({"t": (t, "date"), "ok": (t.where("date < '2024-01-01'"), "date")}, bounds))
    assert got[("date_range", "t")] == ("FAIL", "2023-01-01..2024-07-01")
    assert got[("date_range", "ok")][0] == "PASS"


def test_all_null_column_fails_unless_allowed(spark):
    t = spark.createDataFrame([(1, None, None), (2, None, None)], "a int, b string, zip_code string")
    got = status(dq.check_empty_columns({"t": (t, ["zip_code"]), "u": (t.select("a"), [])}))
    assert got[("empty_columns", "t")] == ("FAIL", "b")
    assert got[("empty_columns", "u")] == ("PASS", "")


def test_totals_mismatch_fails(spark):
    a = spark.createDataFrame([(10.00,), (5.50,)], "v double")
    b = spark.createDataFrame([(15.50,)], "v double")
    c = spark.createDataFrame([(15.52,)], "v double")
    got = status(dq.check_totals({"ok": (a, "v", b, "v"), "bad": (a, "v", c, "v")}))
    assert got[("reconcile", "ok")] == ("PASS", "0.00")
    assert got[("reconcile", "bad")] == ("FAIL", "0.02")


def test_expected_rows(spark):
    t = spark.range(5)
    got = status(dq.check_expected_rows({"t": (t, spark.createDataFrame([(6,)], "n int"))}))
    assert got[("expected_rows", "t")] == ("FAIL", "5/6")


def test_alignment_detects_missing_day_and_wrong_total(spark):
    src = spark.createDataFrame([(d("2024-01-01"), 1.0), (d("2024-01-01"), 2.0), (d("2024-01-02"), 4.0),
                                 (d("2024-01-03"), 1.0)], "date date, v double")
    roll = spark.createDataFrame([(d("2024-01-01"), 3.0), (d("2024-01-02"), 5.0)], "date date, v double")
    got = status(dq.check_alignment("r", src, roll, "date", [("v", F.sum("v"), F.sum("v"))]))
    assert got[("alignment_v", "r")] == ("FAIL", "2")


def test_overlap_check_really_compares(spark):
    raw = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2)], "src string, x int")
    kept_ok = raw.where(~((F.col("src") == "b") & (F.col("x") == 1)))
    cond = (F.col("src") == "b") & (F.col("x") == 1)
    assert status(dq.check_overlap("t", raw, kept_ok, cond))[("overlap_removal", "t")][0] == "PASS"
    assert status(dq.check_overlap("t", raw, raw, cond))[("overlap_removal", "t")] == ("FAIL", "3-1=3")


def test_formula_mismatch(spark):
    t = spark.createDataFrame([(2, 10.0, 1.0, 18.0), (1, 5.0, 0.0, 4.0)],
                              "quantity bigint, unit_price double, discount_per_unit double, line_revenue double")
    assert status(dq.check_formula("t", t))[("revenue_formula", "t")] == ("FAIL", "1")


def test_exists_and_summary(spark):
    empty = spark.createDataFrame([], "a int")
    res = dq.check_exists({"full": spark.range(3), "empty": empty})
    got = status(res)
    assert got[("exists", "full")] == ("PASS", "non-empty") and got[("exists", "empty")] == ("FAIL", "empty")
    summ = {r.status: r.checks for r in dq.suite_summary(res).collect()}
    assert summ == {"PASS": 1, "FAIL": 1, "TOTAL": 2}


def test_month_counts(spark):
    t = spark.createDataFrame([(d("2024-01-01"),), (d("2024-01-31"),), (d("2024-02-01"),)], "date date")
    got = {(r.table_name, r.month): r.n_rows for r in dq.month_counts({"t": (t, "date")}).collect()}
    assert got == {("t", "2024-01"): 2, ("t", "2024-02"): 1}


def test_paths_totals_and_counts(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.createDataFrame([(1.25,), (2.50,)], "v double").write.parquet(p)
    got = status(dq.check_paths_exist(spark, {"t": p, "gone": str(tmp_path / "none")}))
    assert got[("exists", "t")][0] == "PASS" and got[("exists", "gone")] == ("FAIL", "missing")
    t = spark.read.parquet(p)
    tot = status(dq.check_expected_totals({"ok": (t, "v", 3.75), "bad": (t, "v", 3.80)}))
    assert tot[("expected_total", "ok")] == ("PASS", "3.75") and tot[("expected_total", "bad")][0] == "FAIL"
    cnt = status(dq.check_expected_counts({"t": (t, 2), "u": (t, 3)}))
    assert cnt[("expected_rows", "t")] == ("PASS", "2/2") and cnt[("expected_rows", "u")] == ("FAIL", "2/3")


def test_geo_columns(spark):
    from martline.plans.explore import geo_columns
    a = spark.createDataFrame([(1, "x", "y")], "id int, dma_name string, airport_code string")
    assert geo_columns({"a": a}) == [("a", "dma_name")]


def test_suite_with_materialised_inputs_matches(spark):
    import os
    from conftest import SF_SMALL
    if not os.path.exists(f"{SF_SMALL}/lineitem.parquet"):
        return
    from martline.registry import run_suite
    a = run_suite(spark, SF_SMALL)
    b = run_suite(spark, SF_SMALL, materialize=True)
    assert sorted(a.collect()) == sorted(b.collect())
