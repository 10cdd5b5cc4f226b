"""Fact jobs (T1-T8): raw extracts -> source-grain and daily fact tables.

Each job is a pure DataFrame -> DataFrame function.  Source-grain tables and
daily rollups are built from the same cleaned frame (K2): it is written once
and both read it (:func:`martline.sources.sinks.write_outputs`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.functions.dates import to_day
from martline.operators.drift import PAID_DRIFT_RULES, PAID_TARGET, resolve_drift, resolve_drift_tagged
from martline.operators.joins import sized_join
from martline.operators.overlap import drop_overlap, expand_period
from martline.operators.rollup import rollup

# ------------------------------------------------------------------ T1 paid social
# The declared grain.
PAID_GRAIN = ("date", "channel", "campaign_id", "dma_name")


def paid_social_daily(parts: Mapping[str, DataFrame] | DataFrame, rules=PAID_DRIFT_RULES,
                      target=PAID_TARGET, source_col: str = "_file") -> DataFrame:
    """Drift-resolving union of the paid-social extracts (no aggregation).

    ``parts`` is either one DataFrame per extract (extracts read with their
    own headers) or a single frame of all extracts tagged by ``source_col``.
    """
    if isinstance(parts, DataFrame):
        return resolve_drift_tagged(parts, source_col, rules, target)
    return resolve_drift(parts, rules, target)


# ------------------------------------------------------------------ T2/T3 web
# Columns and keys of the web tables.
WEB_EVENT_COLS = ("date", "event_datetime", "user_id", "session_id", "page_url", "traffic_source",
                  "traffic_medium", "campaign", "device_category", "dma_name", "state", "zip_code")
WEB_DAILY_KEYS = ("date", "traffic_source", "traffic_medium", "campaign", "device_category",
                  "dma_name", "state")


def web_events(raw: DataFrame, source_col: str, drop_source: str, start: str, end: str) -> DataFrame:
    """Remove one extract's copy of the overlap window, keep source grain."""
    clean = drop_overlap(raw, source_col, drop_source, "event_datetime", start, end)
    return clean.withColumn("date", to_day("event_datetime")).select(*WEB_EVENT_COLS)


def web_daily(events: DataFrame) -> DataFrame:
    """Daily rollup; null keys are kept as their own group (trap Z1)."""
    return rollup(events, WEB_DAILY_KEYS,
                  [("pageviews", "count", "event_datetime"),
                   ("sessions", "nunique", "session_id"),
                   ("users", "nunique", "user_id")],
                  keep_null_keys=True)


# ------------------------------------------------------------------ T4/T5 ecommerce
# Columns and keys of the ecommerce tables.
TXN_COLS = ("date", "order_id", "user_id", "dma_name", "state", "zip_code", "product_category",
            "size", "quantity", "unit_price", "unit_cost", "discount_per_unit", "line_revenue",
            "promo_flag")
TXN_MONEY = ("unit_price", "unit_cost", "discount_per_unit", "line_revenue")
ECOM_KEYS = ("date", "dma_name", "state", "product_category", "size", "promo_flag")


def ecommerce_clean(raw: DataFrame) -> DataFrame:
    """Shared cleaned frame of T4/T5 (K2): date from the order timestamp."""
    return raw.withColumn("date", to_day("order_datetime"))


def ecommerce_transactions(clean: DataFrame) -> DataFrame:
    """T4: every line item (negatives kept), money exposed as DOUBLE."""
    return clean.select(*[F.col(c).cast("double").alias(c) if c in TXN_MONEY else F.col(c)
                          for c in TXN_COLS])


def ecommerce_daily(clean: DataFrame, keys: Sequence[str] = ECOM_KEYS) -> DataFrame:
    """T5: daily rollup; money summed exactly as DECIMAL, exposed as DOUBLE."""
    df = (clean.withColumn("_disc_x_qty", F.col("discount_per_unit") * F.col("quantity"))
          .withColumn("_cost_x_qty", F.col("unit_cost") * F.col("quantity")))
    return rollup(df, keys,
                  [("orders", "nunique", "order_id"),
                   ("line_items", "count", "order_id"),
                   ("total_quantity", "sum", "quantity"),
                   ("gross_revenue", "money", "line_revenue"),
                   ("total_discount", "money", "_disc_x_qty"),
                   ("total_cost", "money", "_cost_x_qty"),
                   ("avg_unit_price", "money_mean", "unit_price")], fine=True)


# ------------------------------------------------------------------ T6 organic
# The summed metrics.
ORGANIC_SUMS = ("impressions", "video_views", "video_completes", "likes", "comments", "shares",
                "clicks", "saves")


def organic_daily(posts: DataFrame) -> DataFrame:
    """Posts distinct, followers at end of day = max, the rest summed."""
    return rollup(posts, ("date",),
                  [("posts", "nunique", "post_id"), ("followers_eod", "max", "followers")]
                  + [(c, "sum", c) for c in ORGANIC_SUMS])


# ------------------------------------------------------------------ T7 podcast
def podcast_daily(mentions: DataFrame, order_by: Sequence[str] = ("mention_datetime",)) -> DataFrame:
    """One row per (date, show, episode); 'first' is first non-null by mention time."""
    df = mentions.withColumn("date", to_day("mention_datetime"))
    return rollup(df, ("date", "podcast_name", "episode_title"),
                  [("host_name", "first", "host_name"),
                   ("mentions_brand", "max", "mentions_brand"),
                   ("mentions_founder", "max", "mentions_founder"),
                   ("sentiment", "first", "sentiment"),
                   ("estimated_impressions", "sum", "estimated_impressions"),
                   ("episode_rating", "first", "episode_rating"),
                   ("mentions", "count", "podcast_name")],
                  order_by=order_by)


# ------------------------------------------------------------------ T8 OOH
# The table's columns.
OOH_COLS = ("date", "airport_code", "airport_name", "state", "format", "audience_segment",
            "spend", "impressions", "placements")


def ooh_daily(weekly: DataFrame, lookup: DataFrame) -> DataFrame:
    """Enrich weekly rows with the airport state, then spread over 7 days.

    The lookup join runs on the weekly rows (1/7 of the output).  The lookup
    table grows with the number of airports, so it is broadcast only under
    the size check.
    """
    lk = lookup.select(F.col("iata_code").alias("airport_code"), "state")
    enriched = sized_join(weekly, lk, "airport_code", "left")
    daily = expand_period(enriched, "week_start_date", 7, ("spend", "impressions"), ("placements",))
    return daily.select(*OOH_COLS)


def ooh_daily_totals(weekly: DataFrame) -> DataFrame:
    """Per-date OOH totals for the cross-channel mart: aggregate the weekly rows
    first (exact DECIMAL sums), then spread the weekly totals over 7 days."""
    wk = weekly.groupBy("week_start_date").agg(F.sum("spend").alias("spend"),
                                                F.sum("impressions").alias("impressions"))
    daily = expand_period(wk, "week_start_date", 7, ("spend", "impressions"))
    return daily.select("date", F.col("spend").alias("ooh_spend"), F.col("impressions").alias("ooh_impressions"))
