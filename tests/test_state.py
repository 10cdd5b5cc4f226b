"""Mergeable states: merged parts say what the whole says."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from martline.plans import state


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(60_000).selectExpr("id % 50 AS day", "CASE WHEN id % 11 = 0 THEN NULL ELSE id % 7919 END AS user", "(id * 37) % 1000 / 4.0 AS v",
                                          "CASE WHEN id % 3 = 0 THEN NULL ELSE id % 5 END AS w", "CAST(NULL AS int) AS none")


def test_distincts_merge_over_any_range(spark, rows):
    daily = state.distinct_state(rows, ["day"], ["user"])
    for low, high in ((0, 49), (10, 12), (3, 3)):
        part = daily.where(F.col("day").between(low, high))
        merged = state.estimates(state.merge_distincts(part, [F.lit(1).alias("all")], ["user"]), ["user"]).first()
        exact = rows.where(F.col("day").between(low, high)).agg(F.count_distinct("user").alias("u"), F.count("*").alias("n")).first()
        assert merged.n_rows == exact.n and abs(merged.user - exact.u) <= 0.05 * exact.u
    # merged is what one pass over the rows gives
    one = state.estimates(state.distinct_state(rows, [], ["user"]), ["user"]).first().user
    assert abs(one - state.estimates(state.merge_distincts(daily, [], ["user"]), ["user"]).first().user) <= 0.02 * one


def test_error_over_many_sets(spark):
    """The stated standard error, over sets of different sizes."""
    many = spark.range(200_000).selectExpr("id % 40 AS k", "id AS v")
    est = [r.v for r in state.estimates(state.distinct_state(many, ["k"], ["v"]), ["v"]).collect()]
    errors = np.array(est) / 5000 - 1
    assert np.sqrt((errors ** 2).mean()) < 0.025 and np.abs(errors).max() < 0.06


def test_profiles_merge_exactly(spark, rows):
    cols = ["v", "w", "none"]
    whole = {r.column_name: r for r in state.profile_of(state.profile_state(rows, cols)).collect()}
    parts = state.profile_state(rows, cols, ["day"])
    merged = {r.column_name: r for r in state.profile_of(state.merge_profiles(parts), quantiles=(0.25, 0.5)).collect()}
    exact = rows.agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("stdev"), F.avg("w").alias("wm"), F.stddev_samp("w").alias("ws")).first()
    for name in cols:
        a, b = whole[name], merged[name]
        assert (a.n_rows, a.nulls, a.min, a.max, a.mean, a.stdev) == (b.n_rows, b.nulls, b.min, b.max, b.mean, b.stdev)
    assert merged["v"].mean == pytest.approx(exact["mean"]) and merged["v"].stdev == pytest.approx(exact["stdev"])
    assert merged["w"].mean == pytest.approx(exact["wm"]) and merged["w"].stdev == pytest.approx(exact["ws"])
    assert (merged["none"].nulls, merged["none"].mean, merged["none"].stdev, merged["none"].q50) == (60_000, None, None, None)
    values = np.sort(np.array([r.v for r in rows.select("v").collect()], float))
    for q, found in ((0.25, merged["v"].q25), (0.5, merged["v"].q50)):
        assert abs(np.searchsorted(values, found) / len(values) - q) < 0.02


def test_new_part_alone_is_read(spark, rows):
    known = state.profile_state(rows.where("day < 49"), ["v"], ["day"])
    new = state.profile_state(rows.where("day = 49"), ["v"], ["day"])
    a = state.profile_of(state.merge_profiles(known.unionByName(new))).first()
    b = state.profile_of(state.profile_state(rows, ["v"])).first()
    assert (a.n_rows, a.mean, a.stdev) == (b.n_rows, b.mean, b.stdev)


def test_no_rows(spark, rows):
    none = rows.limit(0)
    assert state.distinct_state(none, ["day"], ["user"]).count() == 0
    r = state.profile_of(state.profile_state(none, ["v"])).first()
    assert (r.n_rows, r.nulls, r.mean, r.q50) == (0, 0, None, None)
