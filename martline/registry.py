"""Named queries over the driver tables: one entry per operator/job of SURVEY §2.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame computed
from the whole input tables.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.operators.joins import bridge_join, drill_across, star_join
from martline.operators import keys, ordered
from martline.plans import dims, explore, facts, marts, profile, state, storage
from martline.plans import quality as dq
from martline.plans import warehouse as wh
from martline.plans.checks import COUNT, Suite, groups, total
from martline.session import ensure_checkpoint_dir, forget_plans
from martline.sources import position, views
from martline.sources.views import PLATFORMS

QUERIES = {}


def query(name: str):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, d: str) -> DataFrame:
            forget_plans()  # plans hold file listings; a table may have been rewritten since the last query
            return fn(spark, d)
        QUERIES[name] = run
        return fn
    return deco


def _stored(df: DataFrame, name: str, base: str | None = None) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read from there."""
    spark = df.sparkSession
    base = base or f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(f"{base}/{name}")
    return spark.read.parquet(f"{base}/{name}")


@query("ecommerce_daily")
def q_ecommerce_daily(spark: SparkSession, d: str) -> DataFrame:
    return wh.ecommerce_daily(spark, d)


@query("transactions")
def q_transactions(spark: SparkSession, d: str) -> DataFrame:
    return wh.ecommerce_transactions(spark, d)


# ------------------------------------------------------------------ facts


@query("web_events_dedup")
def q_web_events(spark, d):
    return wh.web_events(spark, d)


@query("web_daily")
def q_web_daily(spark, d):
    return wh.web_daily(spark, d)


def _paid_out(df: DataFrame) -> DataFrame:
    return df.withColumn("spend", F.col("spend").cast("double"))


@query("paid_social_union")
def q_paid_social(spark, d):
    return _paid_out(wh.paid_social(spark, d))


@query("drift_report")
def q_drift_report(spark, d):
    from martline.plans.profile import drift_report_tagged
    return drift_report_tagged(views.paid_raw(spark, d), "_file", views.paid_file_columns(),
                               stream_of=lambda f: f.split("_")[0])


@query("organic_daily")
def q_organic(spark, d):
    return wh.organic_daily(spark, d)


@query("mentions_daily")
def q_mentions(spark, d):
    return wh.podcast_daily(spark, d)


@query("ooh_daily")
def q_ooh(spark, d):
    return wh.ooh_daily(spark, d)


# ------------------------------------------------------------------ dimensions
@query("date_dim")
def q_date_dim(spark, d):
    return wh.date_spine(spark, d)


@query("geography_dim")
def q_geography(spark, d):
    return wh.geography(spark, d)


@query("show_dim")
def q_show_dim(spark, d):
    return dims.show_dim(views.v_mentions(spark, d))


@query("channel_dim")
def q_channel_dim(spark, d):
    """D3 with the number of fact rows each channel carries (read from the facts)."""
    paid = wh.paid_social(spark, d).groupBy(F.lower("channel").alias("channel_name")).agg(
        F.count(F.lit(1)).alias("fact_rows"))
    other = [("organic_tiktok", wh.organic_daily(spark, d)), ("web", wh.web_events(spark, d)),
             ("podcast", wh.podcast_daily(spark, d)), ("ooh_airport", wh.ooh_daily(spark, d))]
    counts = paid
    for name, df in other:
        counts = counts.unionByName(df.agg(F.count(F.lit(1)).alias("fact_rows"))
                                    .select(F.lit(name).alias("channel_name"), "fact_rows"))
    return dims.channel_dim(spark).join(counts, "channel_name", "left") \
        .na.fill(0, subset=["fact_rows"])


@query("initiative_dim")
def q_initiative_dim(spark, d):
    """D4 with paid spend and web page views attributed through the bridge."""
    bridge = dims.initiative_dim(spark)
    paid = bridge_join(wh.paid_social(spark, d), bridge, "campaign_name", "paid_social_campaign_pattern",
                       ["initiative_key"])
    web = bridge_join(wh.web_events(spark, d), bridge, "campaign", "web_analytics_campaign_value",
                      ["initiative_key"], null_as="None")
    ps = paid.groupBy("initiative_key").agg(F.sum("spend").cast("double").alias("paid_spend"))
    wv = web.groupBy("initiative_key").agg(F.count(F.lit(1)).alias("web_pageviews"))
    return (bridge.join(ps, "initiative_key", "left").join(wv, "initiative_key", "left")
            .na.fill(0, subset=["paid_spend", "web_pageviews"]))


@query("initiative_bridge")
def q_initiative_bridge(spark, d):
    """Normalised bridge — every campaign value seen in the data and its initiative."""
    bridge = dims.initiative_dim(spark)
    paid = wh.paid_social(spark, d).groupBy(F.col("campaign_name").alias("campaign_value")).agg(
        F.count(F.lit(1)).alias("n_rows")).withColumn("stream", F.lit("paid_social"))
    web = wh.web_events(spark, d).groupBy(F.col("campaign").alias("campaign_value")).agg(
        F.count(F.lit(1)).alias("n_rows")).withColumn("stream", F.lit("web"))
    p = bridge_join(paid, bridge, "campaign_value", "paid_social_campaign_pattern",
                    ["initiative_key", "initiative_name"])
    w = bridge_join(web, bridge, "campaign_value", "web_analytics_campaign_value",
                    ["initiative_key", "initiative_name"], null_as="None")
    return p.unionByName(w).select("stream", "campaign_value", "initiative_key", "initiative_name", "n_rows")


@query("star_join")
def q_star_join(spark, d):
    """Paid fact joined to date, channel and geography dimensions."""
    fact = wh.paid_social(spark, d)
    dd = wh.date_spine(spark, d).select("date", "season_flag")
    ch = dims.channel_dim(spark).select("channel_key", "channel_name", "channel_group")
    geo = wh.geography(spark, d).where(F.col("geo_scope") == "local").select("geo_key", "dma_name", "state")
    j = star_join(fact, [(dd, ["date"]),
                         (ch, lambda f, d: F.lower(f["channel"]) == d["channel_name"]),
                         (geo, ["dma_name", "state"])])
    return j.select("date", "campaign_id", "channel_key", "geo_key", "season_flag", "channel_group",
                    F.col("spend").cast("double").alias("spend"), "clicks")


@query("drill_across")
def q_drill_across(spark, d):
    """Paid spend and ecommerce revenue at the shared (date, dma_name) grain."""
    paid = wh.paid_social(spark, d).groupBy("date", "dma_name").agg(
        F.sum("spend").cast("double").alias("paid_spend"))
    rev = wh.transactions_clean(spark, d).groupBy("date", "dma_name").agg(
        F.sum("line_revenue").cast("double").alias("revenue"))
    return drill_across(paid, rev, ["date", "dma_name"])


# ------------------------------------------------------------------ marts

WEB_SOURCES = ("direct", "email", "google", "instagram", "partner")


@query("cross_channel_daily")
def q_cross_channel(spark, d):
    return wh.cross_channel(spark, d)


@query("residual_series")
def q_residual_series(spark, d):
    return marts.residual_series(wh.cross_channel(spark, d))


@query("lag_corr_raw")
def q_lag_raw(spark, d):
    return marts.lag_correlations(wh.cross_channel(spark, d))


@query("lag_corr_resid")
def q_lag_resid(spark, d):
    return marts.lag_correlations(wh.cross_channel(spark, d), residual=True)


@query("lag_corr_calendar")
def q_lag_calendar(spark, d):
    """N3 in calendar mode (y taken k days later) on the raw series."""
    return marts.lag_correlations(wh.cross_channel(spark, d), mode="calendar")


@query("peak_lag")
def q_peak_lag(spark, d):
    from martline.operators.stats import peak_lag
    daily = wh.cross_channel(spark, d)
    raw = peak_lag(marts.lag_correlations(daily)).withColumn("series", F.lit("raw"))
    res = peak_lag(marts.lag_correlations(daily, residual=True)).withColumn("series", F.lit("residual"))
    return raw.unionByName(res)


@query("seasonal_inflation")
def q_seasonal_inflation(spark, d):
    from martline.operators.stats import seasonal_inflation
    daily = wh.cross_channel(spark, d)
    return seasonal_inflation(marts.lag_correlations(daily), marts.lag_correlations(daily, residual=True))


@query("semi_partial_corr")
def q_semi_partial(spark, d):
    return marts.partial_correlation(wh.cross_channel(spark, d))


@query("partial_corr")
def q_partial(spark, d):
    return marts.partial_correlation(wh.cross_channel(spark, d), true_partial=True)


@query("promo_impact")
def q_promo(spark, d):
    return marts.promo_impact(wh.transactions_clean(spark, d))


@query("season_summary")
def q_season_summary(spark, d):
    return marts.season_summary(wh.cross_channel(spark, d))


@query("kpi_table")
def q_kpi(spark, d):
    """Transactions and the mart are written once; the daily table and the promo figures read the first, all other summaries the second."""
    from martline.operators.stats import seasonal_inflation
    txn = _stored(wh.transactions_clean(spark, d), "transactions_clean")
    mart = marts.cross_channel_daily(wh.date_spine(spark, d), wh.paid_social(spark, d), wh.web_daily(spark, d), facts.ecommerce_daily(txn),
                                     wh.organic_daily(spark, d), wh.podcast_daily(spark, d), wh.ooh_totals(spark, d))
    daily = _stored(mart, "cross_channel_daily")
    infl = seasonal_inflation(marts.lag_correlations(daily), marts.lag_correlations(daily, residual=True))
    return marts.kpi_table(daily, infl, marts.promo_impact(txn), marts.season_summary(daily), marts.partial_correlation(daily))


@query("revenue_smooth")
def q_revenue_smooth(spark, d):
    return marts.revenue_smooth(wh.cross_channel(spark, d))


@query("season_bands")
def q_season_bands(spark, d):
    return marts.season_bands(wh.date_spine(spark, d))


@query("spend_vs_revenue")
def q_spend_vs_revenue(spark, d):
    return marts.spend_vs_revenue(wh.cross_channel(spark, d))


@query("platform_pivot")
def q_platform_pivot(spark, d):
    return marts.pivot_smooth(wh.paid_social(spark, d), "date", "channel", "spend", PLATFORMS, money=True)


@query("source_pivot")
def q_source_pivot(spark, d):
    return marts.pivot_smooth(wh.web_daily(spark, d), "date", "traffic_source", "sessions", WEB_SOURCES)


@query("channel_group_smooth")
def q_channel_group(spark, d):
    return marts.channel_group_smooth(wh.web_daily(spark, d), wh.source_groups(spark))


@query("season_points")
def q_season_points(spark, d):
    return marts.season_points(wh.cross_channel(spark, d))


# ------------------------------------------------------------------ data quality

DQ_TABLES = ("fact_paid_social_daily", "fact_web_analytics_events", "fact_web_analytics_daily",
             "fact_ecommerce_transactions", "fact_ecommerce_daily", "fact_organic_social_daily",
             "fact_podcast_daily", "fact_ooh_daily", "dim_date", "dim_geography", "dim_podcast",
             "dim_channel", "dim_campaign_initiative")
DAILY_FACTS = ("fact_paid_social_daily", "fact_web_analytics_daily", "fact_ecommerce_daily",
               "fact_organic_social_daily", "fact_podcast_daily", "fact_ooh_daily")


def _dq_inputs(spark, d, materialize: bool = False):
    """Table provider for the quality checks.

    ``materialize=True`` (the whole suite) writes each fact, dimension and
    derived raw input once as a table under the shared checkpoint folder, so
    the many checks that read it share one computation and read only the
    columns they need; raw row counts still read the inputs.
    """
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/suite-{uuid.uuid4().hex}" if materialize else ""
    derived = {
        "raw_paid": lambda: views.paid_raw(spark, d),
        "raw_ooh_weekly": lambda: views.v_ooh_weekly(spark, d),
        "raw_txn": lambda: wh.transactions_clean(spark, d),
        "raw_web_parts": lambda: views.v_web_parts(spark, d),
    }
    memo = {}

    def get(name: str) -> DataFrame:
        if name not in memo:
            df = derived[name]() if name in derived else wh.table_by_name(spark, d, name)
            memo[name] = _stored(df, name, base) if materialize else df
        return memo[name]
    return get


def _dq_exists(t):
    return dq.check_exists({n: t(n) for n in DQ_TABLES})


def _dq_grain(t):
    return dq.check_grain({n: (t(n), k) for n, k in wh.GRAINS.items()})


def _dq_date_range(t):
    bounds = t("dim_date").agg(F.min("date").alias("start"), F.max("date").alias("end"))
    return dq.check_date_range({n: (t(n), "date") for n in wh.FACT_NAMES}, bounds)


def _dq_empty_cols(t):
    tables = {n: (t(n), ()) for n in wh.FACT_NAMES}
    tables["dim_geography"] = (t("dim_geography"), ("zip_code",))
    return dq.check_empty_columns(tables)


def _dq_reconcile(t):
    # raw paid spend: each extract's own spend column (spend_usd where it has one, P14)
    paid_raw = t("raw_paid").select(F.coalesce("spend_usd", "spend").alias("spend"))
    return dq.check_totals({
        "fact_paid_social_daily": (paid_raw, "spend", t("fact_paid_social_daily"), "spend"),
        "fact_ooh_daily": (t("raw_ooh_weekly"), "spend", t("fact_ooh_daily"), "spend"),
        "fact_ecommerce_daily": (t("raw_txn"), "line_revenue", t("fact_ecommerce_daily"), "gross_revenue"),
    })


def _dq_expected(t, spark, d):
    weekly = t("raw_ooh_weekly").agg((F.count(F.lit(1)) * 7).alias("n"))
    li = views.table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))
    ev = views.table(spark, d, "events").agg(F.count(F.lit(1)).alias("n"))
    grain = t("raw_paid").select("date", "channel", "campaign_id", "dma_name").distinct() \
        .agg(F.count(F.lit(1)).alias("n"))
    return dq.check_expected_rows({
        "fact_ooh_daily": (t("fact_ooh_daily"), weekly),
        "fact_ecommerce_transactions": (t("fact_ecommerce_transactions"), li),
        "fact_web_analytics_events": (t("fact_web_analytics_events"), ev),
        "fact_paid_social_daily": (t("fact_paid_social_daily"), grain),
    })


def _dq_alignment(t):
    ecom = dq.check_alignment("fact_ecommerce_daily", t("raw_txn"), t("fact_ecommerce_daily"), "date", [
        ("revenue", F.sum("line_revenue"), F.sum("gross_revenue")),
        ("quantity", F.sum("quantity"), F.sum("total_quantity")),
        ("line_items", F.count(F.lit(1)), F.sum("line_items"))])
    web = dq.check_alignment("fact_web_analytics_daily", t("fact_web_analytics_events"),
                             t("fact_web_analytics_daily"), "date", [("pageviews", F.count(F.lit(1)), F.sum("pageviews"))])
    return ecom.unionByName(web)


def _dq_overlap(t):
    start, end = wh.WEB_OVERLAP
    dropped = (F.col("_source") == wh.WEB_DROP_SOURCE) & F.to_date("event_datetime").between(
        F.lit(start).cast("date"), F.lit(end).cast("date"))
    return dq.check_overlap("fact_web_analytics_events", t("raw_web_parts"), t("fact_web_analytics_events"), dropped)


def _dq_formula(t):
    return dq.check_formula("fact_ecommerce_transactions", t("raw_txn"))


@query("dq_exists")
def q_dq_exists(spark, d):
    return _dq_exists(_dq_inputs(spark, d))


@query("dq_grain")
def q_dq_grain(spark, d):
    return _dq_grain(_dq_inputs(spark, d))


@query("dq_date_range")
def q_dq_date_range(spark, d):
    return _dq_date_range(_dq_inputs(spark, d))


@query("dq_empty_cols")
def q_dq_empty_cols(spark, d):
    return _dq_empty_cols(_dq_inputs(spark, d))


@query("dq_reconcile")
def q_dq_reconcile(spark, d):
    return _dq_reconcile(_dq_inputs(spark, d))


@query("dq_expected")
def q_dq_expected(spark, d):
    return _dq_expected(_dq_inputs(spark, d), spark, d)


@query("dq_alignment")
def q_dq_alignment(spark, d):
    return _dq_alignment(_dq_inputs(spark, d))


@query("dq_overlap")
def q_dq_overlap(spark, d):
    return _dq_overlap(_dq_inputs(spark, d))


@query("dq_month_counts")
def q_dq_month_counts(spark, d):
    return dq.month_counts({n: (wh.table_by_name(spark, d, n), "date") for n in DAILY_FACTS})


@query("dq_formula")
def q_dq_formula(spark, d):
    return _dq_formula(_dq_inputs(spark, d))


def run_suite(spark, d, materialize: bool = False) -> DataFrame:
    """All check rows of the suite.  ``materialize=True`` writes each input once
    and checks the written tables (for stored warehouses see ``plans.rebuild``)."""
    t = _dq_inputs(spark, d, materialize)
    parts = [_dq_exists(t), _dq_grain(t), _dq_date_range(t), _dq_empty_cols(t), _dq_reconcile(t),
             _dq_expected(t, spark, d), _dq_alignment(t), _dq_overlap(t), _dq_formula(t)]
    allr = parts[0]
    for r in parts[1:]:
        allr = allr.unionByName(r)
    return allr


def warehouse_suite() -> Suite:
    """The checks of ``run_suite``, declared for one pass per table."""
    ecom, web = "fact_ecommerce_daily", "fact_web_analytics_daily"
    start, end = wh.WEB_OVERLAP
    dropped = (F.col("_source") == wh.WEB_DROP_SOURCE) & F.to_date("event_datetime").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    suite = Suite().dated(dim_date="date", raw_txn="date", **{n: "date" for n in wh.FACT_NAMES}).exists(*DQ_TABLES)
    for name, keys in wh.GRAINS.items():
        suite.grain(name, keys)
    for name in wh.FACT_NAMES:
        suite.date_range(name, "dim_date").filled(name)
    paid_keys = ("date", "channel", "campaign_id", "dma_name")
    return (suite.filled("dim_geography", ("zip_code",))
            # each extract's own spend column (spend_usd where it has one, P14)
            .totals("fact_paid_social_daily", ("raw_paid", total(F.coalesce("spend_usd", "spend"), "paid")), ("fact_paid_social_daily", total("spend")))
            .totals("fact_ooh_daily", ("raw_ooh_weekly", total("spend")), ("fact_ooh_daily", total("spend")))
            .totals(ecom, ("raw_txn", total("line_revenue")), (ecom, total("gross_revenue")))
            .expected("fact_ooh_daily", ("fact_ooh_daily", COUNT), ("raw_ooh_weekly", COUNT), factor=7)
            .expected("fact_ecommerce_transactions", ("fact_ecommerce_transactions", COUNT), ("lineitem", COUNT))
            .expected("fact_web_analytics_events", ("fact_web_analytics_events", COUNT), ("events", COUNT))
            .expected("fact_paid_social_daily", ("fact_paid_social_daily", COUNT), ("raw_paid", groups(paid_keys)))
            .alignment(ecom, "raw_txn", ecom, [("revenue", total("line_revenue"), total("gross_revenue")), ("quantity", total("quantity"), total("total_quantity")),
                                               ("line_items", COUNT, total("line_items"))])
            .alignment(web, "fact_web_analytics_events", web, [("pageviews", COUNT, total("pageviews"))])
            .overlap("fact_web_analytics_events", "raw_web_parts", "fact_web_analytics_events", dropped)
            .formula("fact_ecommerce_transactions", "raw_txn"))


def fused_suite(spark, d) -> DataFrame:
    """All check rows of the suite in one plan that reads each table once."""
    return warehouse_suite().dealt(*wh.SUITE_DEALT).rows(spark, functools.partial(wh.suite_table, spark, d))


@query("dq_suite")
def q_dq_suite(spark, d):
    return fused_suite(spark, d)


@query("dq_summary")
def q_dq_summary(spark, d):
    """Q11: counts of the suite's check rows per status."""
    return dq.suite_summary(fused_suite(spark, d))


# ------------------------------------------------------------------ profiling

@query("profile_columns")
def q_profile_columns(spark, d):
    return profile.column_profile(wh.ecommerce_transactions(spark, d))


@query("numeric_profile")
def q_numeric_profile(spark, d):
    return profile.numeric_profile(wh.ecommerce_transactions(spark, d))


@query("top_values")
def q_top_values(spark, d):
    return profile.top_values(wh.web_events(spark, d),
                              ["traffic_source", "traffic_medium", "campaign", "device_category", "dma_name"], 5)


def _stream_timestamps(spark, d):
    """(table_name, ts) for four raw streams of different cadence."""
    web = wh.web_events(spark, d).select(F.lit("web_events").alias("table_name"), F.col("event_datetime").alias("ts"))
    txn = views.v_txn(spark, d).select(F.lit("transactions").alias("table_name"), F.col("order_datetime").alias("ts"))
    ooh = views.v_ooh_weekly(spark, d).select(F.lit("ooh_weekly").alias("table_name"),
                                              F.col("week_start_date").cast("timestamp_ntz").alias("ts"))
    orders = views.table(spark, d, "orders").select(F.lit("orders").alias("table_name"), F.col("o_orderdate").alias("ts"))
    return web.unionByName(txn).unionByName(ooh).unionByName(orders)


@query("granularity")
def q_granularity(spark, d):
    return profile.granularity(_stream_timestamps(spark, d), "ts", ["table_name"])


@query("date_profile")
def q_date_profile(spark, d):
    return profile.date_profile(_stream_timestamps(spark, d), "ts", ["table_name"])


@query("overlap_report")
def q_overlap_report(spark, d):
    return profile.overlap_report(views.v_web_parts(spark, d), "_source", "event_datetime")


@query("inventory")
def q_inventory(spark, d):
    """One row per raw extract; each stream is read once."""
    def one(name: str, df: DataFrame, dates: list[str]) -> profile.Extracts:
        return profile.Extracts(df, F.lit(name), {name: df.columns}, {name: dates})

    paid = {f"paid_{f}": cols for f, cols in views.paid_file_columns().items()}
    web = views.v_web_parts(spark, d)
    tags = [f"{tag}_web_traffic" for tag in ("web_a", "web_b")]
    return profile.inventory(spark, [
        profile.Extracts(views.paid_raw(spark, d), F.concat(F.lit("paid_"), F.col("_file")), paid, {f: ["date"] for f in paid}),
        profile.Extracts(web, F.concat(F.col("_source"), F.lit("_web_traffic")), {f: [c for c in web.columns if c != "_source"] for f in tags},
                         {f: ["event_datetime", "date"] for f in tags}),
        one("transactions", views.v_txn(spark, d), ["order_datetime", "date"]),
        one("podcast_mentions", views.v_mentions(spark, d), ["mention_datetime", "episode_release_date"]),
        one("tiktok_owned_posts", views.v_posts(spark, d), ["date"]),
        one("ooh_airport_weekly", views.v_ooh_weekly(spark, d), ["week_start_date"])])


# ------------------------------------------------------------------ exploration
# The candidate keys tested for each stream.
TXN_KEYS = (("order_id",), ("order_id", "product_category"), ("order_id", "product_category", "size"),
            ("order_id", "product_category", "size", "quantity", "unit_price", "date"), ("order_id", "line_number"))
PAID_KEYS = (("date", "channel", "campaign_id", "dma_name"),
             ("date", "channel", "campaign_id", "dma_name", "optimization_goal"),
             ("date", "channel", "campaign_id", "dma_name", "age_target"),
             ("date", "channel", "campaign_id", "dma_name", "audience_segment"),
             ("date", "channel", "campaign_id", "dma_name", "age_target", "audience_segment"),
             ("date", "channel", "campaign_id", "dma_name", "optimization_goal", "age_target", "audience_segment"))
WEB_KEYS = (("event_datetime", "user_id", "session_id", "page_url"),)
ORGANIC_KEYS = (("date", "post_id"),)
PODCAST_KEYS = (("podcast_name", "episode_title", "mention_datetime"),)
OOH_KEYS = (("week_start_date", "airport_code"), ("week_start_date", "airport_code", "format"),
            ("week_start_date", "airport_code", "audience_segment"),
            ("week_start_date", "airport_code", "format", "audience_segment"), ("airport_code",))


@query("key_battery")
def q_key_battery(spark, d):
    parts = [(wh.ecommerce_transactions(spark, d), TXN_KEYS, "fact_ecommerce_transactions"),
             (views.v_ooh_weekly(spark, d), OOH_KEYS, "ooh_weekly"), (views.v_web_parts(spark, d), WEB_KEYS, "web_events"),
             (views.v_posts(spark, d), ORGANIC_KEYS, "organic_posts"), (views.v_mentions(spark, d), PODCAST_KEYS, "podcast_mentions")]
    out = None
    for df, keys, name in parts:
        r = explore.key_battery(df, keys, name)
        out = r if out is None else out.unionByName(r)
    return out


@query("paid_key_battery")
def q_paid_key_battery(spark, d):
    """E2 per file: the paid keys tested inside each extract."""
    return explore.key_battery(views.paid_base(spark, d), PAID_KEYS, "paid_social", file_col="_file")


@query("overlap_keys")
def q_overlap_keys(spark, d):
    return explore.overlap_keys(views.v_web_parts(spark, d), "_source",
                                ["event_datetime", "user_id", "page_url"], "event_datetime")


@query("sessions_per_day")
def q_sessions_per_day(spark, d):
    return explore.distinct_per_day(wh.web_events(spark, d), "event_datetime",
                                    {"sessions": "session_id", "users": "user_id"})


@query("basket_distribution")
def q_basket(spark, d):
    return explore.basket_distribution(wh.transactions_clean(spark, d))


@query("order_values")
def q_order_values(spark, d):
    return explore.order_values(wh.transactions_clean(spark, d))


def _posts_split(spark, d):
    p = views.v_posts(spark, d)
    return p.withColumn("_file", F.when(F.col("date") < F.lit("1998-01-16").cast("date"), "posts_a")
                        .otherwise("posts_b"))


@query("recycled_ids")
def q_recycled(spark, d):
    return explore.recycled_ids(_posts_split(spark, d), "post_id", "_file", "date", "followers", "posts_a", "posts_b")


@query("follower_drops")
def q_follower_drops(spark, d):
    return explore.follower_series(views.v_posts(spark, d))


@query("release_vs_mention")
def q_release(spark, d):
    return explore.release_vs_mention(views.v_mentions(spark, d))


@query("multi_mentions")
def q_multi(spark, d):
    return explore.multi_mentions(views.v_mentions(spark, d))


@query("promo_crosstab")
def q_promo_crosstab(spark, d):
    return explore.promo_crosstab(wh.transactions_clean(spark, d))


def _raw_dates(spark, d):
    """The date column of each raw stream: podcasts by release, airports by week."""
    return {"paid_social": views.paid_base(spark, d).select("date"),
            "web_analytics": views.v_web(spark, d).select(F.to_date("event_datetime").alias("date")),
            "ecommerce": views.v_txn(spark, d).select(F.to_date("order_datetime").alias("date")),
            "organic_social": views.v_posts(spark, d).select("date"),
            "podcast": views.v_mentions(spark, d).select(F.col("episode_release_date").alias("date")),
            "ooh": views.v_ooh_weekly(spark, d).select(F.col("week_start_date").alias("date"))}


@query("spine_coverage")
def q_spine_coverage(spark, d):
    return explore.spine_coverage(_raw_dates(spark, d))


@query("uncovered_days")
def q_uncovered_days(spark, d):
    """Days between the first and the last of any stream that have, or lack, data in some stream."""
    return explore.union_coverage(_raw_dates(spark, d))


def _local_streams(spark, d):
    return {"paid_social": views.paid_base(spark, d), "web": views.v_web(spark, d),
            "ecommerce": views.v_txn(spark, d)}


@query("presence_matrix")
def q_presence(spark, d):
    return explore.value_presence(_local_streams(spark, d), "dma_name")


@query("near_match")
def q_near_match(spark, d):
    """Market names that differ only by case or spacing across the local streams
    and the airport list's municipalities (normalised key F8)."""
    names = (views.v_txn(spark, d).select(F.col("dma_name").alias("name"))
             .unionByName(views.v_web(spark, d).select(F.col("dma_name").alias("name")))
             .unionByName(views.paid_base(spark, d).select(F.col("dma_name").alias("name")))
             .unionByName(views.airports_raw(spark, d).select(F.col("municipality").alias("name"))))
    return explore.near_match(names, "name")


@query("state_format")
def q_state_format(spark, d):
    streams = _local_streams(spark, d)
    streams["airport_lookup"] = views.all_airports(spark, d)
    return explore.state_format(streams, "state")


@query("campaign_linkage")
def q_campaign_linkage(spark, d):
    """Web campaign values linked to paid campaign names by containment."""
    from martline.functions.text import remainder_after_first_space
    from martline.operators.joins import substring_pairs
    pairs = substring_pairs(wh.web_events(spark, d), "campaign", views.paid_base(spark, d), "campaign_name")
    theme = remainder_after_first_space(F.col("right_value"))
    return pairs.select(F.col("left_value").alias("web_campaign"), F.col("right_value").alias("paid_campaign"),
                        theme.alias("paid_theme"), (theme == F.col("left_value")).alias("exact_theme_match"))


@query("campaign_crosstab")
def q_campaign_crosstab(spark, d):
    """Campaign x source x medium counts."""
    return wh.web_events(spark, d).groupBy("campaign", "traffic_source", "traffic_medium").agg(
        F.count(F.lit(1)).alias("n_rows"))


@query("geo_terms")
def q_geo_terms(spark, d):
    """Per show the geographic terms in its name and its founder mentions."""
    terms = spark.createDataFrame(list(explore.GEO_TERMS), "kind string, term string, mode string")
    return explore.geo_signals(views.v_mentions(spark, d), terms)


@query("geo_summary")
def q_geo_summary(spark, d):
    """Shows with and without geographic terms, with and without founder mentions."""
    terms = spark.createDataFrame(list(explore.GEO_TERMS), "kind string, term string, mode string")
    return explore.geo_summary(explore.geo_signals(views.v_mentions(spark, d), terms))


@query("metric_distribution")
def q_metric_distribution(spark, d):
    return explore.metric_distribution(views.v_mentions(spark, d), "podcast_name", "estimated_impressions")


@query("podcast_metrics")
def q_podcast_metrics(spark, d):
    """Impressions and ratings over the whole stream."""
    m = views.v_mentions(spark, d)
    long = m.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v"))
                                        for c in ("estimated_impressions", "episode_rating")])).alias("_u")).select("_u.*")
    return explore.metric_distribution(long, "metric", "v")


@query("campaign_exact")
def q_campaign_exact(spark, d):
    """Which campaign values occur in the web events, among paid names and among paid themes."""
    from martline.functions.text import remainder_after_first_space
    paid = views.paid_base(spark, d).select("campaign_name").distinct()
    return explore.value_presence({
        "web": wh.web_events(spark, d).select("campaign").where(F.length("campaign") > 0),
        "paid_name": paid.select(F.col("campaign_name").alias("campaign")),
        "paid_theme": paid.select(remainder_after_first_space(F.col("campaign_name")).alias("campaign")).where("campaign IS NOT NULL")},
        "campaign")


@query("ols_line")
def q_ols(spark, d):
    """Least-squares line of daily revenue on paid spend."""
    from martline.operators.stats import ols_line
    line = ols_line(wh.cross_channel(spark, d), "paid_social_spend", "ecomm_revenue")
    return line.select(F.round("slope", 6).alias("slope"), F.round("intercept", 2).alias("intercept"))


@query("dq_expected_total")
def q_dq_expected_total(spark, d):
    """Q6: expected totals (here the source table's) against the facts."""
    total = views.table(spark, d, "lineitem").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("v"))
    return dq.check_expected_totals({"fact_paid_social_daily": (wh.paid_social(spark, d), "spend", total),
                                     "raw_ooh_weekly": (views.v_ooh_weekly(spark, d), "spend", total)})


@query("airport_lookup")
def q_airport_lookup(spark, d):
    """The airport list restricted to the wanted codes."""
    return wh.airport_lookup(spark, d)


@query("sentiment_shares")
def q_sentiment_shares(spark, d):
    from martline.operators.sets import value_shares
    return value_shares(views.v_mentions(spark, d), "sentiment")


@query("stable_sample")
def q_stable_sample(spark, d):
    return explore.stable_sample(wh.ecommerce_transactions(spark, d), ["order_id", "product_category", "quantity"], 20)


@query("distinct_values")
def q_distinct_values(spark, d):
    """Product categories seen in the transactions and in the daily fact."""
    return explore.distinct_values({"fact_ecommerce_transactions": wh.transactions_clean(spark, d),
                                    "fact_ecommerce_daily": wh.ecommerce_daily(spark, d)}, "product_category")


@query("missing_dates")
def q_missing_dates(spark, d):
    """Days each raw stream lacks inside its own range (the weekly one lacks six of seven)."""
    return explore.missing_dates(_raw_dates(spark, d))


@query("duplicate_rows")
def q_duplicate_rows(spark, d):
    """Full-row duplicates across the two raw web extracts (the overlap window)."""
    from martline.operators.sets import duplicate_rows
    return duplicate_rows(views.v_web_parts(spark, d).drop("_source"))


@query("date_columns")
def q_date_columns(spark, d):
    """Which columns of the raw transactions (read untyped, as strings) hold dates."""
    raw = views.v_txn(spark, d).select("order_datetime", "order_id", "dma_name", "product_category", "size")
    untyped = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return profile.detect_date_columns(untyped)


@query("airport_inventory")
def q_airport_inventory(spark, d):
    return explore.airport_inventory(views.v_ooh_weekly(spark, d))


@query("campaign_ids")
def q_campaign_ids(spark, d):
    """Paid campaign id -> name mapping (is it one-to-one?)."""
    return explore.id_name_map(wh.paid_social(spark, d), "campaign_id", "campaign_name")


@query("daily_distincts")
def q_daily_distincts(spark, d):
    """Exact per-day distinct orders/sessions/users vs the summed per-group counts."""
    return marts.daily_distincts(wh.transactions_clean(spark, d), wh.web_events(spark, d),
                                 wh.ecommerce_daily(spark, d), wh.web_daily(spark, d))


@query("discount_by_promo")
def q_discount_by_promo(spark, d):
    """Distribution of the per-unit discount for each promo flag."""
    return explore.metric_distribution(wh.ecommerce_transactions(spark, d), "promo_flag", "discount_per_unit")


@query("post_id_reuse")
def q_post_id_reuse(spark, d):
    """How many post ids occur on 1, 2, ... rows (id recycling)."""
    from martline.operators.sets import size_histogram
    return size_histogram(views.v_posts(spark, d), "post_id", "uses").withColumnRenamed("groups", "post_ids")


@query("follower_first_decreases")
def q_follower_first_decreases(spark, d):
    """The first ten days on which the follower count fell (a top-k report)."""
    s = explore.follower_series(views.v_posts(spark, d))
    return s.where("decreased").orderBy("date").limit(10).select("date", "followers", "prev_followers")


@query("negative_revenue_lines")
def q_negative_revenue_lines(spark, d):
    """The first five line items with negative revenue (by date, order, then all columns)."""
    txn = wh.ecommerce_transactions(spark, d).where(F.col("line_revenue") < 0)
    order = ["date", "order_id", "product_category", "size", "quantity", "unit_price", "line_revenue",
             "discount_per_unit", "promo_flag"]  # every output column: ties are identical rows
    return txn.orderBy(*order).limit(5).select(*order)


@query("sessions_edge_days")
def q_sessions_edge_days(spark, d):
    """Sessions and users on the first three and the last three days."""
    per_day = explore.distinct_per_day(wh.web_events(spark, d), "event_datetime",
                                       {"sessions": "session_id", "users": "user_id"})
    first = per_day.orderBy(F.col("date").asc()).limit(3).withColumn("edge", F.lit("first"))
    last = per_day.orderBy(F.col("date").desc()).limit(3).withColumn("edge", F.lit("last"))
    return first.unionByName(last)


# ------------------------------------------------------------------ written files: sources and sinks

@query("csv_types")
def q_csv_types(spark, d):
    """Types inferred from all values of a table written as CSV in two column orders."""
    return storage.csv_types(views.table(spark, d, "lineitem"))


@query("csv_round_trip")
def q_csv_round_trip(spark, d):
    """A table written as CSV and read back with inferred types (decimals shown as DOUBLE)."""
    back = storage.csv_round_trip(views.table(spark, d, "lineitem"))
    return back.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in back.dtypes])


@query("csv_untyped")
def q_csv_untyped(spark, d):
    """Empty fields stay empty texts."""
    return storage.csv_untyped(views.v_web(spark, d).select("event_datetime", "user_id", "page_url", "traffic_source", "campaign", "zip_code"))


@query("month_slice")
def q_month_slice(spark, d):
    """K1: a date range read from month folders."""
    return storage.month_slice(wh.web_events(spark, d), "date", "1998-01-10", "1998-02-20")


@query("replaced_table")
def q_replaced_table(spark, d):
    """K1: a table replaced as a whole, both versions read back."""
    orders = views.table(spark, d, "orders")
    return storage.replaced_table(orders, orders.where("o_orderstatus = 'F'"))


@query("two_outputs")
def q_two_outputs(spark, d):
    """K2: tables from one cleaned frame."""
    return storage.two_outputs(wh.transactions_clean(spark, d), {"detail": facts.ecommerce_transactions, "daily": facts.ecommerce_daily},
                               row_by_row=("detail",))


@query("published_tables")
def q_published(spark, d):
    """K3: copies verified by checksum, and a single changed value found."""
    tables = {n: views.table(spark, d, n) for n in ("customer", "part", "supplier")}
    changed = {n: t.withColumn(c, F.when(F.col(t.columns[0]) == 1, F.col(c) + 0.01).otherwise(F.col(c)))
               for (n, t), c in zip(tables.items(), ("c_acctbal", "p_retailprice", "s_acctbal"))}
    return storage.published(tables, changed)


@query("step_metrics")
def q_step_metrics(spark, d):
    """K4: rows in, rows out, dates and actions of the source-grain web step and two daily ones."""
    from martline.sources.sinks import Step, step_metrics, write_table
    steps = []
    for name, source, build, actions in (
            ("web_events", views.v_web_parts(spark, d), lambda df: facts.web_events(df, "_source", wh.WEB_DROP_SOURCE, *wh.WEB_OVERLAP), "overlap dropped"),
            ("organic_daily", views.v_posts(spark, d), facts.organic_daily, "grouped by day"),
            ("podcast_daily", views.v_mentions(spark, d), facts.podcast_daily, "grouped by day, show and episode")):
        step = Step(name, "date", actions)
        write_table(step.out(build(step.into(source))), storage.scratch(spark, "step"))
        steps.append(step)
    return step_metrics(spark, steps)


@query("exported_order")
def q_exported_order(spark, d):
    """O1/O2: each order's place in a CSV export sorted by customer, then price from the highest."""
    done = storage.exported_order(views.table(spark, d, "orders"), ["o_custkey", "o_totalprice", "o_orderkey"], ["o_totalprice"], ["o_orderkey"])
    return done.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "place")


@query("first_appearance")
def q_first_appearance(spark, d):
    """Users numbered by the first row of the file that has them, with that row's event."""
    events = position.read_parquet_rows(spark, f"{d}/events.parquet")
    numbers = position.number_by_appearance(events, ["user_id"], "user_number")
    first = position.first_rows(events, ["user_id"], ["event_type", "value"])
    return numbers.join(first, "user_id")


@query("event_rolling")
def q_event_rolling(spark, d):
    """W1-W4 at event grain: trailing and centred means, residual and previous value over all events in time order."""
    e = views.table(spark, d, "events").select("event_id", "ts", F.col("value").cast("decimal(18,4)").alias("value"))
    order, buckets = ["ts", "event_id"], [F.date_trunc("month", "ts"), F.to_date("ts")]
    means = ordered.rolling_means(e, ["value"], order, buckets, 7, min_periods=1, suffix="_7")
    centred = ordered.rolling_means(e, ["value"], order, buckets, 14, center=True, suffix="_14", residual="_resid")
    previous = ordered.previous_values(e, ["value"], order, buckets, suffix="_prev")
    out = means.select("event_id", "value_7").join(centred.select("event_id", "value_14", "value_resid"), "event_id")
    return out.join(previous.select("event_id", F.col("value_prev").cast("double").alias("value_prev")), "event_id")


# ------------------------------------------------------------------ keys and mergeable states

@query("minimal_keys")
def q_minimal_keys(spark, d):
    """Minimal keys of up to two columns, found level by level."""
    return keys.key_report(spark, {n: views.table(spark, d, n) for n in ("customer", "events", "lineitem", "orders", "part", "supplier")}, max_size=2)


@query("monthly_distincts")
def q_monthly_distincts(spark, d):
    """A2: monthly distinct sessions and users from the daily states, held against exact counts (within 5%)."""
    events, cols = wh.web_events(spark, d), ["session_id", "user_id"]
    daily = _stored(state.distinct_state(events, ["date"], cols), "daily_state")
    month = F.date_format("date", "yyyy-MM").alias("month")
    merged = state.estimates(state.merge_distincts(daily, [month], cols), cols)
    exact = events.groupBy(month).agg(*[F.count_distinct(c).alias(f"{c}s") for c in cols])
    close = [(F.abs(F.col(c) - F.col(f"{c}s")) <= F.greatest(F.lit(1.0), 0.05 * F.col(f"{c}s"))).alias(f"{c}s_close") for c in cols]
    return merged.join(exact, "month").select("month", "n_rows", *[f"{c}s" for c in cols], *close)


@query("profile_merged")
def q_profile_merged(spark, d):
    """Profile of the transactions merged from monthly states; distinct counts held against exact ones (within 5%)."""
    txn = wh.ecommerce_transactions(spark, d).withColumn("month", F.date_format("date", "yyyy-MM"))
    cols = ["quantity", "unit_price", "line_revenue"]
    monthly = _stored(state.profile_state(txn, cols, ["month"]), "profile_state")
    found = state.profile_of(state.merge_profiles(monthly))
    named = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols])
    exact = txn.select(F.inline(named)).groupBy("c").agg(F.count_distinct("v").alias("exact"))
    close = (F.abs(F.col("n_unique") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.05 * F.col("exact"))).alias("unique_close")
    return found.join(exact, F.col("column_name") == F.col("c")).select("column_name", "n_rows", "nulls", "min", "max", F.round("mean", 6).alias("mean"),
                                                                        F.round("stdev", 4).alias("stdev"), close)


@query("raw_spend_totals")
def q_raw_spend_totals(spark, d):
    """Spend of each raw extract from the first of its spend columns."""
    from martline.functions.numeric import MONEY
    from martline.operators.drift import first_present
    out = None
    for name, part in sorted(views.paid_parts(spark, d).items()):
        spend = part.select(first_present(part, ["spend_usd", "spend"], "spend"))
        row = spend.agg(F.count("spend").alias("n_rows"), F.sum(F.col("spend").cast(MONEY)).cast("double").alias("spend")).select(F.lit(name).alias("file"), "n_rows", "spend")
        out = row if out is None else out.unionByName(row)
    return out


@query("geo_columns")
def q_geo_columns(spark, d):
    """The streams' columns with a geographic name, with their rows and distinct values."""
    streams = {"ooh": views.v_ooh_weekly(spark, d), "podcast": views.v_mentions(spark, d), "transactions": views.v_txn(spark, d), "web": views.v_web(spark, d)}
    named = explore.geo_columns(streams)
    out = None
    for name in sorted({t for t, _ in named}):
        cols = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for t, c in named if t == name])
        found = streams[name].select(F.inline(cols)).groupBy("column_name").agg(F.count("v").alias("filled"), F.count_distinct("v").alias("distinct_values"))
        found = found.select(F.lit(name).alias("table_name"), "column_name", "filled", "distinct_values")
        out = found if out is None else out.unionByName(found)
    return out
