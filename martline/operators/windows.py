"""Ordered/window operators (W1-W6; surrogate keys W7 are in ``quantiles``).

These run on daily series (one row per day, or per entity-day).  Without a
``partition`` the window sorts the whole input in one task, so callers apply
them only after aggregation to one row per day (a few thousand rows even for
a decade).  Multi-entity series pass ``partition`` and run in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _window(order: str, partition: Sequence[str], lo: int, hi: int):
    w = Window.partitionBy(*partition) if partition else Window
    return w.orderBy(F.col(order)).rowsBetween(lo, hi)


def rolling_mean(df: DataFrame, cols: Sequence[str], order: str = "date", window: int = 7,
                 center: bool = False, min_periods: int | None = None,
                 partition: Sequence[str] = (), suffix: str = "_roll") -> DataFrame:
    """Pandas ``rolling(window, center, min_periods).mean()``.

    Frame: trailing ``[t-window+1, t]``; centred ``[t-window//2, t+(window-1)//2]``
    (for an even window pandas puts the extra row before t).  The mean is null
    unless at least ``min_periods`` (default ``window``) non-null values are in
    the frame.
    """
    if center:
        lo, hi = -(window // 2), (window - 1) // 2
    else:
        lo, hi = -(window - 1), 0
    need = window if min_periods is None else min_periods
    w = _window(order, partition, lo, hi)
    out = df
    for c in cols:
        out = out.withColumn(c + suffix, F.when(F.count(F.col(c)).over(w) >= need, F.avg(F.col(c)).over(w)))
    return out


def residuals(df: DataFrame, cols: Sequence[str], order: str = "date", window: int = 14,
              partition: Sequence[str] = (), suffix: str = "__resid") -> DataFrame:
    """Value minus its centred rolling mean (full window required)."""
    lo, hi = -(window // 2), (window - 1) // 2
    w = _window(order, partition, lo, hi)
    out = df
    for c in cols:
        trend = F.when(F.count(F.col(c)).over(w) >= window, F.avg(F.col(c)).over(w))
        out = out.withColumn(c + suffix, F.col(c) - trend)
    return out


def previous_value(df: DataFrame, col: str, order: str = "date", partition: Sequence[str] = (),
                   out: str = "prev") -> DataFrame:
    """Value on the previous present row."""
    w = (Window.partitionBy(*partition) if partition else Window).orderBy(F.col(order))
    return df.withColumn(out, F.lag(F.col(col)).over(w))


def day_gaps(dates: DataFrame, date_col: str = "date", partition: Sequence[str] = ()) -> DataFrame:
    """Days between successive distinct dates (per partition)."""
    d = dates.select(*partition, F.col(date_col)).where(F.col(date_col).isNotNull()).distinct()
    w = (Window.partitionBy(*partition) if partition else Window).orderBy(F.col(date_col))
    return d.withColumn("gap", F.datediff(F.col(date_col), F.lag(F.col(date_col)).over(w)))
