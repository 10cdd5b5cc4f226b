"""The warehouse over the driver tables: views -> facts -> dims (one place that wires them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.session import per_session

from martline.operators.rollup import dealt
from martline.plans import dims, facts
from martline.sources import files, views

WEB_DROP_SOURCE = "web_b"
WEB_OVERLAP = (views.WEB_B_START, "1998-01-20")  # inclusive dates of web_b to drop


@per_session
def transactions_clean(spark: SparkSession, d: str) -> DataFrame:
    return facts.ecommerce_clean(views.v_txn(spark, d))


@per_session
def ecommerce_transactions(spark: SparkSession, d: str) -> DataFrame:
    return facts.ecommerce_transactions(transactions_clean(spark, d))


@per_session
def ecommerce_daily(spark: SparkSession, d: str) -> DataFrame:
    return facts.ecommerce_daily(transactions_clean(spark, d))


@per_session
def web_events(spark: SparkSession, d: str) -> DataFrame:
    return facts.web_events(views.v_web_parts(spark, d), "_source", WEB_DROP_SOURCE, *WEB_OVERLAP)


@per_session
def web_daily(spark: SparkSession, d: str) -> DataFrame:
    return facts.web_daily(web_events(spark, d))


@per_session
def paid_social(spark: SparkSession, d: str) -> DataFrame:
    return facts.paid_social_daily(views.paid_raw(spark, d))


@per_session
def organic_daily(spark: SparkSession, d: str) -> DataFrame:
    return facts.organic_daily(views.v_posts(spark, d))


@per_session
def podcast_daily(spark: SparkSession, d: str) -> DataFrame:
    return facts.podcast_daily(views.v_mentions(spark, d))


@per_session
def airport_lookup(spark: SparkSession, d: str) -> DataFrame:
    return files.airport_lookup(views.airports_raw(spark, d), views.wanted_airports(spark, d))


@per_session
def ooh_daily(spark: SparkSession, d: str) -> DataFrame:
    return facts.ooh_daily(views.v_ooh_weekly(spark, d), airport_lookup(spark, d))


@per_session
def date_spine(spark: SparkSession, d: str) -> DataFrame:
    """dim_date over the span of the transaction stream."""
    li = views.table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    return dims.date_dim_for(li, "date")


@per_session
def geography(spark: SparkSession, d: str, shared: bool = False) -> DataFrame:
    txn = views.v_txn(spark, d, shared).select("dma_name", "state")
    web = views.v_web(spark, d).select("dma_name", "state")
    paid = views.paid_base(spark, d).select("dma_name", "state")
    return dims.geography_dim([paid, web, txn], views.v_ooh_weekly(spark, d, shared),
                              airport_lookup(spark, d), views.v_mentions(spark, d))


@per_session
def ooh_totals(spark: SparkSession, d: str) -> DataFrame:
    return facts.ooh_daily_totals(views.v_ooh_weekly(spark, d))


@per_session
def cross_channel(spark: SparkSession, d: str) -> DataFrame:
    """N1 over the whole warehouse."""
    from martline.plans import marts
    return marts.cross_channel_daily(date_spine(spark, d), paid_social(spark, d), web_daily(spark, d),
                                     ecommerce_daily(spark, d), organic_daily(spark, d),
                                     podcast_daily(spark, d), ooh_totals(spark, d))


def source_groups(spark: SparkSession) -> DataFrame:
    from martline.plans import marts
    rows = [(src, grp) for grp, srcs in marts.SOURCE_GROUPS for src in srcs]
    return spark.createDataFrame(rows, "traffic_source string, channel_group string")


# ------------------------------------------------------------------ quality suite inputs
FACT_NAMES = {
    "fact_paid_social_daily": paid_social, "fact_web_analytics_events": web_events,
    "fact_web_analytics_daily": web_daily, "fact_ecommerce_transactions": ecommerce_transactions,
    "fact_ecommerce_daily": ecommerce_daily, "fact_organic_social_daily": organic_daily,
    "fact_podcast_daily": podcast_daily, "fact_ooh_daily": ooh_daily,
}

GRAINS = {
    "fact_paid_social_daily": ("date", "channel", "campaign_id", "dma_name"),
    "fact_web_analytics_daily": facts.WEB_DAILY_KEYS,
    "fact_ecommerce_daily": facts.ECOM_KEYS,
    "fact_organic_social_daily": ("date",),
    "fact_podcast_daily": ("date", "podcast_name", "episode_title"),
    "fact_ooh_daily": ("date", "airport_code", "format", "audience_segment"),
    "dim_date": ("date",),
    "dim_geography": ("geo_key",),
}

# tables of the suite that come dealt by columns of their grain
SUITE_DEALT = ("fact_ooh_daily",)


def suite_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table of the quality suite or a raw input of it, built such that those of one stream share its shuffles.

    Placements are dealt by airport as weekly rows, a seventh of the daily
    ones, and the lookup like them: all rows of a daily grain are in one share.
    """
    if name in ("lineitem", "events"):
        return views.table(spark, d, name)
    if name in ("raw_txn", "fact_ecommerce_transactions", "fact_ecommerce_daily"):
        clean = facts.ecommerce_clean(views.v_txn(spark, d, True))
        return {"raw_txn": lambda x: x, "fact_ecommerce_transactions": facts.ecommerce_transactions,
                "fact_ecommerce_daily": facts.ecommerce_daily}[name](clean)
    if name == "raw_ooh_weekly":
        return views.v_ooh_weekly(spark, d, True)
    if name == "fact_ooh_daily":
        weekly = views.v_ooh_weekly(spark, d, True)
        return facts.ooh_daily(weekly, dealt(airport_lookup(spark, d), ["iata_code"], like=weekly))
    if name == "dim_geography":
        return geography(spark, d, True)
    derived = {"raw_paid": views.paid_raw, "raw_web_parts": views.v_web_parts}
    return derived[name](spark, d) if name in derived else table_by_name(spark, d, name)


def table_by_name(spark: SparkSession, d: str, name: str) -> DataFrame:
    if name in FACT_NAMES:
        return FACT_NAMES[name](spark, d)
    return {"dim_date": date_spine, "dim_geography": geography,
            "dim_podcast": lambda s, x: dims.show_dim(views.v_mentions(s, x)),
            "dim_channel": lambda s, x: dims.channel_dim(s),
            "dim_campaign_initiative": lambda s, x: dims.initiative_dim(s)}[name](spark, d)
