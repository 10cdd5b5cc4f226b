"""Property tests (hypothesis) for invariants the reference relies on."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martline.operators import overlap, rollup
from martline.plans import quality as dq

SETTINGS = settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3), st.integers(-50, 50)),
                   min_size=1, max_size=40)


@SETTINGS
@given(rows=rows_st)
def test_rollup_totals_equal_source_totals(spark, rows):
    df = spark.createDataFrame(rows, "k string, d int, v bigint")
    kept = rollup.rollup(df, ["k", "d"], [("s", "sum", "v"), ("n", "count_rows", None)], keep_null_keys=True)
    tot = kept.agg(F.sum("s"), F.sum("n")).collect()[0]
    assert tot[0] == sum(r[2] for r in rows) and tot[1] == len(rows)
    dropped = rollup.rollup(df, ["k", "d"], [("n", "count_rows", None)])
    assert (dropped.agg(F.sum("n")).collect()[0][0] or 0) == sum(1 for r in rows if r[0] is not None)


@SETTINGS
@given(weeks=st.lists(st.tuples(st.integers(0, 20), st.integers(0, 10_000)), min_size=1, max_size=15))
def test_weekly_to_daily_preserves_totals(spark, weeks):
    base = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(base + dt.timedelta(weeks=w), float(v)) for w, v in weeks], "ws date, spend double")
    out = overlap.expand_period(df, "ws", 7, ["spend"])
    assert out.count() == 7 * len(weeks)
    assert out.agg(F.sum("spend")).collect()[0][0] == pytest.approx(sum(v for _, v in weeks))


def test_assert_date_range_raises(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2024, 7, 1),)], "date date")
    assert dq.assert_date_range(df.where("date < '2024-01-01'"), "date", "2023-01-01", "2024-06-30")[0] == dt.date(2023, 1, 1)
    with pytest.raises(ValueError):
        dq.assert_date_range(df, "date", "2023-01-01", "2024-06-30")
