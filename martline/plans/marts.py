"""Analytics marts (N1-N16) on top of the daily facts.

The heavy work (the rollups) stays partitioned; after :func:`cross_channel_daily`
the data is one row per day, so the ordered windows and correlations that
follow work on a few thousand rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.functions import dates as fd
from martline.functions.numeric import MONEY, attenuation_label, safe_ratio, where_nonzero
from martline.operators import stats
from martline.operators.joins import spine_join
from martline.operators.windows import residuals, rolling_mean

SPINE_COLS = ("date", "day_of_week", "season_flag", "is_weekend", "month", "quarter", "year")

# The signal pairs of the lag analysis (x leads y) and the
# columns that get a detrended residual.
SIGNAL_PAIRS = (
    ("paid_social_spend", "web_sessions", "Paid Social Spend → Web Sessions"),
    ("paid_social_spend", "ecomm_revenue", "Paid Social Spend → Ecomm Revenue"),
    ("web_sessions", "ecomm_revenue", "Web Sessions → Ecomm Revenue"),
    ("podcast_impressions", "web_sessions", "Podcast Impressions → Web Sessions"),
    ("organic_impressions", "web_sessions", "Organic Impressions → Web Sessions"),
)
RESID_COLS = ("paid_social_spend", "web_sessions", "ecomm_revenue", "podcast_impressions", "organic_impressions")
RESID_PAIRS = tuple((x + "__resid", y + "__resid", label) for x, y, label in SIGNAL_PAIRS)
DETREND_WINDOW = 14
MAX_LAG = 14
SMOOTH_WINDOW = 7

# Traffic-source groups for the grouped sessions series.
SOURCE_GROUPS = (
    ("Paid Social", ("instagram", "tiktok", "facebook", "pinterest")),
    ("Search", ("google", "bing", "yahoo")),
    ("Non-Paid (Direct + Email)", ("direct", "email")),
)


def _money_sum(c: str) -> F.Column:
    """Sum a money column exactly (values are 2-decimal amounts held as DOUBLE)."""
    return F.coalesce(F.sum(F.col(c).cast(MONEY)), F.lit(0).cast(MONEY)).cast("double")


def cross_channel_daily(date_dim: DataFrame, paid: DataFrame, web_daily: DataFrame, ecom_daily: DataFrame,
                        organic_daily: DataFrame, podcast_daily: DataFrame, ooh_totals: DataFrame) -> DataFrame:
    """Calendar spine + one pre-aggregated row per day from each stream, nulls -> 0."""
    spine = date_dim.select(*SPINE_COLS)
    ps = paid.groupBy("date").agg(
        F.sum("spend").cast("double").alias("paid_social_spend"),
        F.sum("impressions").alias("paid_social_impressions"),
        F.sum("clicks").alias("paid_social_clicks"),
        F.sum("video_views").alias("paid_social_video_views"))
    wa = web_daily.groupBy("date").agg(
        F.sum("pageviews").alias("web_pageviews"), F.sum("sessions").alias("web_sessions"),
        F.sum("users").alias("web_users"))
    ec = ecom_daily.groupBy("date").agg(
        _money_sum("gross_revenue").alias("ecomm_revenue"), F.sum("orders").alias("ecomm_orders"),
        F.sum("total_quantity").alias("ecomm_units"), _money_sum("total_discount").alias("ecomm_discount"))
    org = organic_daily.groupBy("date").agg(
        F.max("followers_eod").alias("followers_eod"), F.sum("impressions").alias("organic_impressions"),
        F.sum("likes").alias("organic_likes"), F.sum("shares").alias("organic_shares"),
        F.sum("comments").alias("organic_comments"))
    pod = podcast_daily.groupBy("date").agg(
        F.sum("mentions").alias("podcast_mentions"), F.sum("estimated_impressions").alias("podcast_impressions"))
    return spine_join(spine, [ps, wa, ec, org, pod, ooh_totals], "date", fill_zero=True)


def residual_series(daily: DataFrame, cols: Sequence[str] = RESID_COLS, window: int = DETREND_WINDOW,
                    digits: int = 6) -> DataFrame:
    """``{c}__resid`` = value - centred rolling mean (full window), nulls at the edges kept."""
    r = residuals(daily.select("date", *cols), cols, "date", window)
    return r.select("date", *cols, *[F.round(c + "__resid", digits).alias(c + "__resid") for c in cols])


def lag_correlations(daily: DataFrame, residual: bool = False, max_lag: int = MAX_LAG,
                     mode: str = "positional") -> DataFrame:
    """Raw or detrended lag correlations for the fixed signal pairs."""
    if residual:
        return stats.lag_correlation(residuals(daily, RESID_COLS, "date", DETREND_WINDOW), RESID_PAIRS,
                                     max_lag, "date", mode)
    return stats.lag_correlation(daily, SIGNAL_PAIRS, max_lag, "date", mode)


def partial_correlation(daily: DataFrame, true_partial: bool = False) -> DataFrame:
    """Spend -> revenue given sessions on the detrended series, with a verdict."""
    r = residuals(daily, ["paid_social_spend", "ecomm_revenue", "web_sessions"], "date", DETREND_WINDOW)
    fn = stats.partial if true_partial else stats.semi_partial
    out = fn(r, "paid_social_spend__resid", "ecomm_revenue__resid", "web_sessions__resid")
    return out.withColumn("interpretation", attenuation_label("simple_corr", "partial_corr"))


def promo_impact(txn: DataFrame) -> DataFrame:
    """Per promo flag, volume, revenue and price metrics in one grouped pass.

    Money is summed as DECIMAL whether the input holds DECIMAL (raw stream)
    or 2-decimal DOUBLE (the stored fact), so totals do not depend on the
    order rows are added in.
    """
    m = {c: F.col(c).cast(MONEY) for c in ("line_revenue", "unit_price", "discount_per_unit")}
    rev = F.sum(m["line_revenue"]).cast("double")
    neg = F.col("line_revenue") < 0
    g = txn.groupBy("promo_flag").agg(
        F.count(F.lit(1)).alias("line_items"),
        F.count_distinct("order_id").alias("distinct_orders"),
        F.sum("quantity").alias("total_quantity"),
        F.round(rev, 2).alias("total_revenue"),
        F.round(safe_ratio(rev, F.count_distinct("order_id")), 2).alias("avg_order_value"),
        F.round(F.try_divide(F.sum(m["unit_price"]).cast("double"), F.count("unit_price")), 2).alias("avg_unit_price"),
        F.round(F.try_divide(F.sum(m["discount_per_unit"]).cast("double"), F.count("discount_per_unit")), 2)
         .alias("avg_discount_per_unit"),
        F.count_if(neg).alias("negative_revenue_rows"),
        F.round(F.coalesce(F.sum(F.when(neg, m["line_revenue"])), F.lit(0).cast(MONEY)).cast("double"), 2)
         .alias("negative_revenue_amount"))
    return g


def _money_avg(c: str) -> F.Column:
    return F.try_divide(F.sum(F.col(c).cast(MONEY)).cast("double"), F.count(c))


def season_summary(daily: DataFrame, digits: int = 4) -> DataFrame:
    """Per season, days and average daily metrics; ROI as a ratio of averages."""
    avg_rev, avg_spend = _money_avg("ecomm_revenue"), _money_avg("paid_social_spend")
    return daily.groupBy("season_flag").agg(
        F.count(F.lit(1)).alias("days"),
        F.round(avg_rev, digits).alias("avg_daily_revenue"),
        F.round(avg_spend, digits).alias("avg_daily_paid_spend"),
        F.round(F.avg("web_sessions"), digits).alias("avg_daily_sessions"),
        F.round(F.avg("ecomm_orders"), digits).alias("avg_daily_orders"),
        F.round(safe_ratio(avg_rev, avg_spend), digits).alias("revenue_per_spend_dollar"))


def revenue_smooth(daily: DataFrame, digits: int = 4) -> DataFrame:
    """Daily revenue with its trailing 7-day mean (partial windows allowed)."""
    r = rolling_mean(daily.select("date", "ecomm_revenue"), ["ecomm_revenue"], "date", SMOOTH_WINDOW,
                     min_periods=1, suffix="_7d")
    return r.select("date", "ecomm_revenue", F.round("ecomm_revenue_7d", digits).alias("revenue_7d"))


def season_bands(daily: DataFrame, seasons=fd.DEFAULT_SEASONS) -> DataFrame:
    """One band per season and year in the data, end clipped to the last date,
    bands starting after the data dropped."""
    rng = daily.agg(F.min("date").alias("_s"), F.max("date").alias("_e"))
    years = rng.select("_e", F.explode(F.sequence(F.year("_s"), F.year("_e"))).alias("year"))
    arr = F.array(*[F.struct(F.lit(lbl).alias("season_flag"), F.lit(int(s[:2])).alias("sm"),
                             F.lit(int(s[3:])).alias("sd"), F.lit(int(e[:2])).alias("em"),
                             F.lit(int(e[3:])).alias("ed")) for lbl, s, e in seasons])
    b = years.select("_e", "year", F.explode(arr).alias("b"))
    start = F.make_date("year", "b.sm", "b.sd")
    end = F.least(F.make_date("year", "b.em", "b.ed"), F.col("_e"))
    return (b.select("b.season_flag", "year", start.alias("band_start"), end.alias("band_end"), "_e")
            .where(F.col("band_start") <= F.col("_e")).drop("_e"))


def spend_vs_revenue(daily: DataFrame, digits: int = 4) -> DataFrame:
    """Total marketing spend (paid + OOH) and revenue, both smoothed."""
    d = daily.select("date", (F.col("paid_social_spend") + F.col("ooh_spend")).alias("total_spend"),
                     "ecomm_revenue")
    r = rolling_mean(d, ["total_spend", "ecomm_revenue"], "date", SMOOTH_WINDOW, min_periods=1, suffix="_7d")
    return r.select("date", F.round("total_spend", digits).alias("total_spend"),
                    F.round("total_spend_7d", digits).alias("spend_7d"),
                    F.round("ecomm_revenue_7d", digits).alias("revenue_7d"))


def pivot_smooth(df: DataFrame, date_col: str, cat_col: str, value_col: str, values: Sequence[str],
                 window: int = SMOOTH_WINDOW, money: bool = False, digits: int = 4) -> DataFrame:
    """Date x category pivot of a sum (missing -> 0) and each
    category's trailing mean.  Passing ``values`` avoids a job to find them."""
    agg = F.sum(F.col(value_col).cast(MONEY)).cast("double") if money else F.sum(value_col)
    names = [v.lower() for v in values]
    p = df.groupBy(date_col).pivot(cat_col, list(values)).agg(agg)
    p = p.select(date_col, *[F.coalesce(F.col(v), F.lit(0)).alias(n) for v, n in zip(values, names)])
    r = rolling_mean(p, names, date_col, window, min_periods=1, suffix="_7d")
    return r.select(date_col, *names, *[F.round(n + "_7d", digits).alias(n + "_7d") for n in names])


def channel_group_smooth(web_daily: DataFrame, mapping: DataFrame, digits: int = 4) -> DataFrame:
    """Sessions per source group (unmapped sources dropped), smoothed per group."""
    j = web_daily.join(F.broadcast(mapping), "traffic_source", "inner")
    g = j.groupBy("channel_group", "date").agg(F.sum("sessions").alias("sessions"))
    r = rolling_mean(g, ["sessions"], "date", SMOOTH_WINDOW, min_periods=1, partition=["channel_group"],
                     suffix="_7d")
    return r.select("channel_group", "date", "sessions", F.round("sessions_7d", digits).alias("sessions_7d"))


def season_points(daily: DataFrame) -> DataFrame:
    """Spend vs sessions per day, labelled by season."""
    return daily.select("date", "season_flag", "paid_social_spend", "web_sessions")


def _unpivot(df: DataFrame, section: str, label, columns: Sequence[str]) -> DataFrame:
    """(section, metric, value) rows of several columns; ``label`` makes the metric's name from a column's."""
    one = [F.struct(F.lit(section).alias("section"), label(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*one)).alias("k")).select("k.*")


def kpi_table(daily: DataFrame, inflation: DataFrame, promo: DataFrame, seasons: DataFrame, partial: DataFrame,
              digits: int = 2, r_digits: int = 3) -> DataFrame:
    """Long (section, metric, value) table of headline numbers: totals, season
    averages, raw and residual correlations, partial correlation, promotion metrics.

    The promotion share divides by the daily mart's revenue.
    """
    t = daily.agg(_money_sum("paid_social_spend").alias("paid_social_spend"), F.sum("ooh_spend").alias("ooh_spend"),
                  _money_sum("ecomm_revenue").alias("ecomm_revenue"), F.sum("ecomm_orders").alias("ecomm_orders"),
                  F.sum("web_pageviews").alias("web_pageviews"), F.sum("podcast_mentions").alias("podcast_mentions"))
    t = t.withColumn("total_spend", F.col("paid_social_spend") + F.col("ooh_spend"))
    t = t.withColumn("spend_to_revenue_ratio", F.try_divide(F.col("total_spend"), F.col("ecomm_revenue")))
    out = _unpivot(t, "totals", F.lit, t.columns)
    out = out.unionByName(_unpivot(seasons, "season", lambda c: F.concat_ws(" ", F.col("season_flag"), F.lit(c)), (
        "days", "avg_daily_revenue", "avg_daily_paid_spend", "avg_daily_sessions", "avg_daily_orders")))
    flags = _unpivot(promo, "promo", lambda c: F.concat_ws(" ", F.concat(F.lit("flag="), F.col("promo_flag")), F.lit(c)), (
        "line_items", "distinct_orders", "total_quantity", "total_revenue", "avg_order_value", "avg_unit_price",
        "avg_discount_per_unit", "negative_revenue_rows", "negative_revenue_amount"))
    share = promo.where(F.col("promo_flag") == 1).select("total_revenue", F.lit(1).alias("_one")).join(
        t.select("ecomm_revenue", F.lit(1).alias("_one")), "_one")
    share = share.select(F.lit("promo").alias("section"), F.lit("promo_revenue_share_pct").alias("metric"),
                         (F.try_divide(F.col("total_revenue"), F.col("ecomm_revenue")) * 100).alias("value"))
    red = F.coalesce(where_nonzero("raw_r", (1 - F.try_divide(F.abs("residual_r"), F.abs("raw_r"))) * 100), F.when(F.col("raw_r") == 0, 0.0))
    corr = inflation.withColumn("reduction_pct", red)
    pair = lambda c: F.concat_ws(" ", F.col("signal_pair"), F.lit(c))
    out = out.unionByName(flags).unionByName(share).unionByName(_unpivot(corr, "correlation", pair, ("reduction_pct",)))
    rs = _unpivot(corr, "correlation", pair, ("raw_r", "residual_r")).unionByName(
        _unpivot(partial, "partial", F.lit, ("simple_corr", "partial_corr")))
    return (out.withColumn("value", F.round("value", digits))
            .unionByName(rs.withColumn("value", F.round("value", r_digits))))


def daily_distincts(txn: DataFrame, web_events: DataFrame, ecom_daily: DataFrame, web_daily: DataFrame) -> DataFrame:
    """Trap Z4: exact distinct orders, sessions and users per day from the
    source grain, next to the reference's sums of per-group distinct counts
    (which over-count when an order or session spans several groups)."""
    o = txn.groupBy("date").agg(F.count_distinct("order_id").alias("orders_exact"))
    w = web_events.groupBy("date").agg(F.count_distinct("session_id").alias("sessions_exact"),
                                       F.count_distinct("user_id").alias("users_exact"))
    eo = ecom_daily.groupBy("date").agg(F.sum("orders").alias("orders_summed"))
    ws = web_daily.groupBy("date").agg(F.sum("sessions").alias("sessions_summed"),
                                       F.sum("users").alias("users_summed"))
    return o.join(eo, "date", "full_outer").join(w.join(ws, "date", "full_outer"), "date", "full_outer")
