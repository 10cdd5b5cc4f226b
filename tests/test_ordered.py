"""Rolling frames over one order in stretches, against pandas over the whole series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from martline.operators import ordered


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(5)
    n = 500
    return pd.DataFrame({"id": np.arange(n), "t": np.sort(rng.integers(0, 90, n)), "v": [None if rng.random() < 0.15 else int(x) for x in rng.integers(-50, 50, n)]})


def frame_of(spark, series):
    rows = [(int(i), int(t), None if pd.isna(v) else int(v)) for i, t, v in series.itertuples(index=False)]
    return spark.createDataFrame(rows, "id bigint, t bigint, v bigint").repartition(5)


def buckets():
    return [F.floor(F.col("t") / 30), F.floor(F.col("t") / 4)]


@pytest.mark.parametrize("window,center,least,stretch", [(7, False, None, 1), (7, False, 1, 10), (14, True, None, 3), (14, True, 1, 64), (3, True, 2, 1), (1, False, None, 5),
                                                         (600, False, 1, 20), (7, True, 1, 1 << 16)])
def test_equals_pandas(spark, series, window, center, least, stretch):
    out = ordered.rolling_means(frame_of(spark, series), ["v"], ["t", "id"], buckets(), window, center, least, residual="_res", stretch=stretch)
    got = out.toPandas().sort_values("id")
    assert list(out.columns) == ["id", "t", "v", "v_roll", "v_res"] and len(got) == len(series)
    want = series.v.astype(float).rolling(window, center=center, min_periods=least).mean()
    np.testing.assert_allclose(got.v_roll.to_numpy(float), want.to_numpy(float), rtol=1e-12, atol=1e-12)
    np.testing.assert_allclose(got.v_res.to_numpy(float), (series.v.astype(float) - want).to_numpy(float), rtol=1e-12, atol=1e-9)


@pytest.mark.parametrize("lag,stretch", [(1, 1), (3, 2), (10, 64)])
def test_previous_values(spark, series, lag, stretch):
    got = ordered.previous_values(frame_of(spark, series), ["v"], ["t", "id"], buckets(), lag, stretch=stretch).toPandas().sort_values("id")
    pd.testing.assert_series_equal(got.v_prev.astype(float).reset_index(drop=True), series.v.astype(float).shift(lag), check_names=False)


def test_no_window_without_partition(spark, series):
    out = ordered.rolling_means(frame_of(spark, series), ["v"], ["t", "id"], buckets(), 7)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("], [_" in line for line in windows)
    assert ordered.rolling_means(frame_of(spark, series).limit(0), ["v"], ["t", "id"], buckets()).collect() == []


def test_rows_are_copied_to_two_neighbours_at_most(spark, series):
    spread = ordered.with_halo(frame_of(spark, series), ["t", "id"], buckets(), 3, 2, stretch=50)
    assert spread.where("_own").count() == len(series)
    assert spread.where("NOT _own").count() == 10 * 5 - 2  # each of ten stretches: three to the next, two to the one before, none before the first
