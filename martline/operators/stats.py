"""Correlation analytics.

All statistics are aggregate expressions; no series is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martline.functions.numeric import pearson, where_nonzero


def long_pairs(df: DataFrame, pairs: Sequence[tuple[str, str, str]], order: str = "date") -> DataFrame:
    """Unpivot a wide daily table into ``(signal_pair, date, x, y)`` rows, one block per pair.

    The ``pairs`` list is a short constant (x column, y column, label); the
    unpivot is a single ``explode`` over an array of structs, so the wide
    table is scanned once.
    """
    arr = F.array(*[F.struct(F.lit(label).alias("signal_pair"),
                             F.col(x).cast("double").alias("x"),
                             F.col(y).cast("double").alias("y"))
                    for x, y, label in pairs])
    return df.select(F.col(order), F.explode(arr).alias("_p")).select(
        "_p.signal_pair", F.col(order), "_p.x", "_p.y")


def lag_correlation(df: DataFrame, pairs: Sequence[tuple[str, str, str]], max_lag: int = 14,
                    order: str = "date", mode: str = "positional", digits: int | None = 6) -> DataFrame:
    """Pearson r of x(t) with y(t+k) for k = 0..max_lag, per pair.

    ``positional`` (reference parity): rows with a null x or y are dropped per
    pair (listwise) and ``y`` is shifted by position: ``lead(y, k)`` over the
    pair's rows in date order, then all lags are aggregated in one pass (one
    shuffle on the pair; a pair holds one row per day).
    ``calendar``: ``y`` is taken ``k`` days later: each x row is exploded into
    its lags and equi-joined on ``(signal_pair, day + k)``, which also handles
    gaps in the calendar.
    """
    lp = long_pairs(df, pairs, order).na.drop(subset=["x", "y"])
    lags = range(max_lag + 1)
    if mode == "positional":
        w = Window.partitionBy("signal_pair").orderBy(F.col(order))
        wide = lp.select("signal_pair", "x", *[F.lead("y", k).over(w).alias(f"_y{k}") for k in lags])
        rs = []
        for k in lags:
            yk = F.col(f"_y{k}")
            r = pearson(F.when(yk.isNotNull(), F.col("x")), yk)
            rs.append((F.round(r, digits) if digits is not None else r).alias(f"_r{k}"))
        g = wide.groupBy("signal_pair").agg(*rs)
        arr = F.array(*[F.struct(F.lit(k).alias("lag_days"), F.col(f"_r{k}").alias("pearson_r")) for k in lags])
        return g.select("signal_pair", F.explode(arr).alias("_l")).select("signal_pair", "_l.lag_days", "_l.pearson_r")
    if mode != "calendar":
        raise ValueError(mode)
    lp = lp.withColumn("pos", F.unix_date(F.col(order)).cast("bigint"))
    xs = lp.select("signal_pair", "pos", "x",
                   F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag_days"))
    ys = lp.select("signal_pair", F.col("pos").alias("ypos"), "y")
    j = xs.join(ys, (xs.signal_pair == ys.signal_pair) & (ys.ypos == xs.pos + xs.lag_days)) \
          .select(xs.signal_pair, "lag_days", "x", "y")
    r = pearson("x", "y")
    if digits is not None:
        r = F.round(r, digits)
    return j.groupBy("signal_pair", "lag_days").agg(r.alias("pearson_r"))


def peak_lag(lags: DataFrame) -> DataFrame:
    """Per pair, the lag with the largest |r| (smallest lag on ties) and r at lag 0."""
    best = F.max_by(F.struct(F.col("lag_days"), F.col("pearson_r")),
                    F.struct(F.abs(F.col("pearson_r")), -F.col("lag_days")))
    return (lags.where(F.col("pearson_r").isNotNull())
            .groupBy("signal_pair")
            .agg(best.alias("_b"),
                 F.max(F.when(F.col("lag_days") == 0, F.col("pearson_r"))).alias("lag0_r"))
            .select("signal_pair", F.col("_b.lag_days").alias("peak_lag"),
                    F.col("_b.pearson_r").alias("peak_r"), "lag0_r"))


def seasonal_inflation(raw: DataFrame, resid: DataFrame, digits: int = 6) -> DataFrame:
    """Lag-0 raw vs residual r; signed (raw - resid) / raw, null when raw = 0."""
    r0 = raw.where(F.col("lag_days") == 0).select("signal_pair", F.col("pearson_r").alias("raw_r"))
    s0 = resid.where(F.col("lag_days") == 0).select("signal_pair", F.col("pearson_r").alias("residual_r"))
    j = r0.join(s0, "signal_pair", "inner")
    pct = where_nonzero("raw_r", (F.col("raw_r") - F.col("residual_r")) / F.col("raw_r"))
    return j.withColumn("percent_reduction", F.round(pct, digits))


def correlation_matrix_terms(df: DataFrame, s: str, y: str, x: str) -> DataFrame:
    """One pass: the three pairwise r's among spend ``s``, outcome ``y`` and control ``x``."""
    sub = df.na.drop(subset=[s, y, x])
    return sub.agg(pearson(s, y).alias("r_sy"), pearson(s, x).alias("r_sx"), pearson(x, y).alias("r_xy"),
                   F.count(F.lit(1)).alias("n"))


def semi_partial(df: DataFrame, s: str, y: str, x: str, digits: int = 6) -> DataFrame:
    """corr(s, residual of y regressed on x) — what the reference calls partial (trap Z5).

    Closed form (r_sy - r_sx r_xy) / sqrt(1 - r_xy^2) from one aggregate pass;
    algebraically identical to fitting y ~ x and correlating s with the error.
    """
    t = correlation_matrix_terms(df, s, y, x)
    semi = F.try_divide(F.col("r_sy") - F.col("r_sx") * F.col("r_xy"), F.sqrt(1 - F.col("r_xy") ** 2))
    return t.select(F.round("r_sy", digits).alias("simple_corr"), F.round(semi, digits).alias("partial_corr"))


def partial(df: DataFrame, s: str, y: str, x: str, digits: int = 6) -> DataFrame:
    """True first-order partial correlation of s and y given x."""
    t = correlation_matrix_terms(df, s, y, x)
    p = F.try_divide(F.col("r_sy") - F.col("r_sx") * F.col("r_xy"),
                     F.sqrt((1 - F.col("r_sx") ** 2) * (1 - F.col("r_xy") ** 2)))
    return t.select(F.round("r_sy", digits).alias("simple_corr"), F.round(p, digits).alias("partial_corr"))


def ols_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares slope and intercept (null for a constant x)."""
    slope = F.try_divide(F.covar_pop(F.col(x), F.col(y)), F.var_pop(F.col(x)))
    sub = df.na.drop(subset=[x, y])
    return sub.agg(slope.alias("slope"), F.avg(x).alias("_mx"), F.avg(y).alias("_my")) \
              .select("slope", (F.col("_my") - F.col("slope") * F.col("_mx")).alias("intercept"))
