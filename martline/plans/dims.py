"""Dimension jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.functions import dates as fd
from martline.functions.text import contains_any
from martline.operators.joins import lookup_first
from martline.operators.sets import distinct_pairs
from martline.operators.quantiles import surrogate_key

# Keywords that mark a show name as Georgia-based (case-sensitive
# substrings), and the state they imply.
GEO_KEYWORDS = ("GA", "ATL", "Peach State")
GEO_STATE = "GA"

# The channel dimension.
CHANNELS = (
    (1, "instagram", "paid_social", True),
    (2, "pinterest", "paid_social", True),
    (3, "tiktok", "paid_social", True),
    (4, "organic_tiktok", "organic_social", False),
    (5, "web", "web_analytics", False),
    (6, "podcast", "earned_media", False),
    (7, "ooh_airport", "ooh", True),
)
CHANNEL_SCHEMA = "channel_key int, channel_name string, channel_group string, is_paid boolean"

# The campaign-initiative bridge (comma-separated list columns).
INITIATIVES = (
    (1, "Always On", "Instagram Always On, Pinterest Always On, TikTok Always On", "Always On",
     "Direct theme match across both streams"),
    (2, "BTS", "Instagram BTS Moms, Pinterest BTS Moms, TikTok BTS Moms", "BTS 2023, BTS 2024",
     "Web uses year-suffixed variants"),
    (3, "Teen Trends", "Instagram Teen Trends, Pinterest Teen Trends, TikTok Teen Trends", None,
     "No web analytics counterpart found"),
    (4, "Black Friday", None, "Black Friday 2023", "Web/promo only — no paid social campaign"),
    (5, "Email Promo", None, "Email Promo", "Web/promo only — no paid social campaign"),
    (6, "Unattributed", None, "None", "Web traffic with explicit 'None' campaign value"),
)
INITIATIVE_SCHEMA = ("initiative_key int, initiative_name string, paid_social_campaign_pattern string, "
                     "web_analytics_campaign_value string, notes string")


def date_dim_from_spine(spine: DataFrame, date_col: str = "date", seasons=fd.DEFAULT_SEASONS) -> DataFrame:
    """D1 attributes for an existing one-column date spine."""
    d = F.col(date_col)
    return spine.select(
        d.alias("date"),
        fd.day_name(d).alias("day_of_week"),
        fd.iso_day_number(d).alias("day_of_week_num"),
        fd.week_start(d).alias("week_start_date"),
        F.month(d).alias("month"),
        fd.month_name(d).alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        fd.is_weekend(d).alias("is_weekend"),
        fd.season_flag(d, seasons).alias("season_flag"),
    )


def date_dim(spark: SparkSession, start: str, end: str, seasons=fd.DEFAULT_SEASONS) -> DataFrame:
    """One row per day between two literal dates (inclusive)."""
    spine = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"),
                                                       F.lit(end).cast("date"))).alias("date"))
    return date_dim_from_spine(spine, seasons=seasons)


def date_dim_for(df: DataFrame, date_col: str, seasons=fd.DEFAULT_SEASONS) -> DataFrame:
    """D1 over the data's own range: min/max is one aggregate, then a narrow explode."""
    rng = df.agg(F.min(date_col).alias("_s"), F.max(date_col).alias("_e"))
    spine = rng.select(F.explode(F.sequence("_s", "_e")).alias("date"))
    return date_dim_from_spine(spine, seasons=seasons)


def channel_dim(spark: SparkSession) -> DataFrame:
    """D3."""
    return spark.createDataFrame(list(CHANNELS), CHANNEL_SCHEMA)


def initiative_dim(spark: SparkSession) -> DataFrame:
    """D4."""
    return spark.createDataFrame(list(INITIATIVES), INITIATIVE_SCHEMA)


def show_dim(mentions: DataFrame, name_col: str = "podcast_name", keywords=GEO_KEYWORDS) -> DataFrame:
    """Shows derived from the data; geography inferred by keyword."""
    names = mentions.select(F.col(name_col).alias("podcast_name")).where(F.col("podcast_name").isNotNull()).distinct()
    hit = contains_any(F.col("podcast_name"), keywords)
    out = names.select("podcast_name",
                       F.when(hit, "explicit").otherwise("unknown").alias("geo_inferred"),
                       F.when(hit, GEO_STATE).alias("geo_state"))
    return surrogate_key(out, [F.col("podcast_name")], "podcast_key", [F.substring("podcast_name", 1, 8)]).select(
        "podcast_key", "podcast_name", "geo_inferred", "geo_state")


def geography_dim(local_sources: Sequence[DataFrame], airports: DataFrame, lookup: DataFrame,
                  shows: DataFrame, keywords=GEO_KEYWORDS) -> DataFrame:
    """Local (dma, state) pairs ∪ national airports ∪ one row per show.

    * local: distinct (dma_name, state) over all local streams, sorted.
    * national: distinct airports of the OOH stream, state by first lookup
      match (J3), in order of first appearance (earliest week, then code).
    * inferred: one row per show name, state from the keyword rule.
    ``geo_key`` numbers the union in that order (W7), in parallel over
    ordered buckets: scope, first week, and the head of the name or code
    (the airport list grows with the data).
    """
    s = T.StringType()
    local = distinct_pairs(local_sources, ["dma_name", "state"]).where(
        F.col("dma_name").isNotNull() | F.col("state").isNotNull())
    local = local.select(
        F.lit(1).alias("_scope"), F.col("dma_name"), F.col("state"), F.lit(None).cast(s).alias("zip_code"),
        F.lit(None).cast(s).alias("airport_code"), F.lit(None).cast(s).alias("airport_name"),
        F.lit("local").alias("geo_scope"),
        F.lit(None).cast("date").alias("_first"), F.col("dma_name").alias("_k1"), F.col("state").alias("_k2"))
    ap = (airports.groupBy("airport_code")
          .agg(F.min_by("airport_name", F.struct("week_start_date", "airport_name")).alias("airport_name"),
               F.min("week_start_date").alias("_first")))
    ap = lookup_first(ap, lookup, "airport_code", "iata_code", ["iata_code", "name"], ["state"])
    national = ap.select(
        F.lit(2).alias("_scope"), F.lit(None).cast(s).alias("dma_name"), F.col("state"),
        F.lit(None).cast(s).alias("zip_code"), "airport_code", "airport_name",
        F.lit("national").alias("geo_scope"), "_first", F.col("airport_code").alias("_k1"),
        F.lit(None).cast(s).alias("_k2"))
    names = shows.select("podcast_name").where(F.col("podcast_name").isNotNull()).distinct()
    inferred = names.select(
        F.lit(3).alias("_scope"), F.lit(None).cast(s).alias("dma_name"),
        F.when(contains_any(F.col("podcast_name"), keywords), GEO_STATE).alias("state"),
        F.lit(None).cast(s).alias("zip_code"), F.lit(None).cast(s).alias("airport_code"),
        F.lit(None).cast(s).alias("airport_name"), F.lit("inferred").alias("geo_scope"),
        F.lit(None).cast("date").alias("_first"), F.col("podcast_name").alias("_k1"),
        F.lit(None).cast(s).alias("_k2"))
    allg = local.unionByName(national).unionByName(inferred)
    keyed = surrogate_key(allg, [F.col("_scope"), F.col("_first").asc_nulls_first(),
                                 F.col("_k1").asc_nulls_last(), F.col("_k2").asc_nulls_last()], "geo_key",
                          [F.col("_scope"), F.col("_first"), F.col("_k1").isNull(), F.substring("_k1", 1, 6)])
    return keyed.select("geo_key", "dma_name", "state", "zip_code", "airport_code", "airport_name", "geo_scope")
