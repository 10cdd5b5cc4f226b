"""Scalar function helpers."""

import datetime as dt

from pyspark.sql import functions as F

from martline.functions import dates as fd
from martline.functions import numeric as fn
from martline.functions import text as ft


def test_calendar_functions(spark):
    df = spark.createDataFrame([(dt.date(2023, 7, 15),), (dt.date(2023, 9, 16),), (dt.date(2023, 12, 10),),
                                (dt.date(2024, 1, 7),)], "d date")
    rows = df.select("d", fd.season_flag("d").alias("s"), fd.iso_day_number("d").alias("n"),
                     fd.week_start("d").alias("w"), fd.is_weekend("d").alias("we"),
                     fd.day_name("d").alias("dn"), fd.month_name("d").alias("mn")).orderBy("d").collect()
    assert [r.s for r in rows] == ["back_to_school", "regular", "black_friday_holiday", "regular"]
    assert rows[3].n == 7 and rows[3].w == dt.date(2024, 1, 1) and rows[3].we and rows[3].dn == "Sunday"
    assert rows[0].mn == "July"


def test_text_functions(spark):
    df = spark.createDataFrame([("  Atlanta,  GA ", "Instagram Always On", "US-GA", "GAzette"),
                                ("Macon", "Solo", "GA", "ATL Talk")], "a string, b string, c string, d string")
    rows = df.select(ft.normalise_key("a").alias("k"), ft.remainder_after_first_space("b").alias("t"),
                     ft.remainder_after_first_dash("c").alias("st"),
                     ft.contains_any("d", ["GA", "ATL"]).alias("geo"),
                     ft.word_match(F.col("d"), F.lit("GA")).alias("w"),
                     ft.is_two_letter_code("st").alias("code")).collect()
    assert rows[0].k == "atlanta, ga" and rows[1].k == "macon"
    assert rows[0].t == "Always On" and rows[1].t is None
    assert rows[0].st == "GA" and rows[1].st == "GA" and rows[0].code
    assert rows[0].geo and rows[1].geo
    assert rows[0].w is False and rows[1].w is False


def test_numeric_functions(spark):
    df = spark.createDataFrame([(1.0, 0.0, 2, 10.0, 1.0, 18.0), (0.5, 0.25, 1, 5.0, 0.0, 5.0)],
                               "simple double, partial double, q bigint, p double, d double, r double")
    rows = df.select(fn.safe_ratio("simple", "partial").alias("ratio"), fn.attenuation_label("simple", "partial").alias("l"),
                     fn.formula_mismatch("q", "p", "d", "r").alias("bad"), fn.where_nonzero("partial", F.lit(1)).alias("nz")
                     ).collect()
    assert rows[0].ratio == 0.0 and rows[1].ratio == 2.0
    assert rows[0].l == "relationship is positive and meaningfully weaker after conditioning"
    assert rows[1].l == "relationship is positive and meaningfully weaker after conditioning"
    assert [r.bad for r in rows] == [False, False] and rows[0].nz is None


def test_parse_and_null_helpers(spark):
    df = spark.createDataFrame([("2024-01-05 10:30:00", None), ("not a date", 1)], "s string, n int")
    from martline.plans.profile import parse_any
    rows = df.select(parse_any(F.col("s")).alias("t"), fd.to_day(parse_any(F.col("s"))).alias("d")).collect()
    assert rows[0].d == dt.date(2024, 1, 5) and rows[1].t is None
    assert df.agg(fn.null_count("n").alias("nulls")).collect()[0].nulls == 1
