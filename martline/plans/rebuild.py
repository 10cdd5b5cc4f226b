"""Full rebuild: raw -> gold facts and dimensions -> marts -> quality rows.

Each layer is written and the next layer reads the written tables, so every
job's lineage starts at stored files (no re-derivation from raw, and a lost
executor only recomputes from the last written table).  The output folder
should be shared storage on a cluster (for example under the folder named
by ``spark.checkpoint.dir``).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.functions.numeric import MONEY
from martline.operators.stats import seasonal_inflation
from martline.plans import dims, facts, marts
from martline.plans import quality as dq
from martline.plans import warehouse as wh
from martline.plans.checks import COUNT, Suite, total
from martline.sources import views
from martline.sources.files import airport_lookup, list_files, read_source, read_tagged
from martline.sources.sinks import Step, publish, read_table, step_metrics, write_outputs, write_table

# Export row order per table (ascending, nulls last), as the
# reference's CSV outputs are sorted.
EXPORT_ORDER = {
    "fact_paid_social_daily": ("date", "channel", "campaign_id", "dma_name"),
    "fact_web_analytics_daily": ("date", "traffic_source", "dma_name"),
    "fact_web_analytics_events": ("date", "event_datetime"),
    "fact_ecommerce_daily": ("date", "dma_name", "product_category", "size"),
    "fact_ecommerce_transactions": ("date", "order_id"),
    "fact_organic_social_daily": ("date",),
    "fact_podcast_daily": ("date", "podcast_name"),
    "fact_ooh_daily": ("date", "airport_code", "format", "audience_segment"),
    "dim_date": ("date",), "dim_geography": ("geo_key",), "dim_channel": ("channel_key",),
    "dim_campaign_initiative": ("initiative_key",), "dim_podcast": ("podcast_key",),
    "cross_channel_daily": ("date",), "lag_correlations": ("signal_pair", "lag_days"),
    "lag_correlations_resid": ("signal_pair", "lag_days"), "promo_impact_summary": ("promo_flag",),
}

DAILY_FACTS = ("fact_paid_social_daily", "fact_web_analytics_daily", "fact_ecommerce_daily",
               "fact_organic_social_daily", "fact_podcast_daily", "fact_ooh_daily")


def _reader(spark: SparkSession, out: str):
    return lambda name: read_table(spark, f"{out}/{name}")


def export_csv(spark: SparkSession, paths: dict[str, str], csv_dir: str) -> dict[str, str]:
    """K1/O1: header CSV copies of the published tables in the reference's row order."""
    from martline.sources.sinks import export_sorted
    out = {}
    for name, order in EXPORT_ORDER.items():
        if name in paths:
            export_sorted(read_table(spark, paths[name]), f"{csv_dir.rstrip('/')}/{name}", list(order))
            out[name] = f"{csv_dir.rstrip('/')}/{name}"
    return out


class Streams(NamedTuple):
    """The raw streams a rebuild starts from: ``web`` is tagged by ``_source``, ``paid`` by ``_file``."""
    paid: DataFrame
    web: DataFrame
    web_drop: tuple[str, str, str]
    transactions: DataFrame
    posts: DataFrame
    mentions: DataFrame
    ooh_weekly: DataFrame
    airports: DataFrame


def view_streams(spark: SparkSession, sf_dir: str) -> Streams:
    """The streams derived from the driver tables."""
    return Streams(views.paid_raw(spark, sf_dir), views.v_web_parts(spark, sf_dir), (wh.WEB_DROP_SOURCE, *wh.WEB_OVERLAP),
                   views.v_txn(spark, sf_dir), views.v_posts(spark, sf_dir), views.v_mentions(spark, sf_dir),
                   views.v_ooh_weekly(spark, sf_dir), wh.airport_lookup(spark, sf_dir))


# Types of the raw extracts' columns that are no strings.
RAW_TYPES = {
    "spend": MONEY, "spend_usd": MONEY, "unit_price": MONEY, "unit_cost": MONEY, "discount_per_unit": MONEY, "line_revenue": MONEY,
    "date": "date", "week_start_date": "date", "episode_release_date": "date", "event_datetime": "timestamp_ntz",
    "order_datetime": "timestamp_ntz", "mention_datetime": "timestamp_ntz", "quantity": "bigint", "promo_flag": "int",
    "mentions_brand": "int", "mentions_founder": "int", "episode_rating": "double",
    **{c: "bigint" for c in ("impressions", "clicks", "link_clicks", "video_views", "views", "video_25pct", "video_50pct", "video_75pct",
                             "video_completes", "followers", "likes", "comments", "shares", "saves", "estimated_impressions", "placements")},
}


def csv_streams(spark: SparkSession, folder: str, airports: DataFrame, web_drop: tuple[str, str, str]) -> Streams:
    """The streams of a folder of raw CSV extracts, told apart by their file names.

    ``web_drop`` is (file, first day, last day) of the overlap to remove from
    one web extract.
    """
    from martline.plans.profile import stream_of_name
    by_stream: dict[str, list[str]] = {}
    for f in list_files(spark, folder):
        stream = stream_of_name(f.name)
        by_stream.setdefault("paid" if stream.startswith("paid_") else stream, []).append(f.path)

    def typed(stream: str, tag: str | None = None) -> DataFrame:
        df, _ = read_tagged(spark, by_stream[stream], source_col="_tag")
        cols = [F.col(c).cast(RAW_TYPES[c]).alias(c) if c in RAW_TYPES else F.col(c) for c in df.columns if c != "_tag"]
        return df.select(*cols, *([F.col("_tag").alias(tag)] if tag else []))

    return Streams(typed("paid", "_file"), typed("web_traffic", "_source"), web_drop, typed("transactions"), typed("tiktok_owned"),
                   typed("podcast_mentions"), typed("ooh_airport"), airports)


def airports_of(spark: SparkSession, path: str) -> DataFrame:
    """The airport lookup from a CSV that has each airport's state, or its region code to take the state from."""
    raw = read_source(spark, path).drop("_source_file")
    if "state" in raw.columns:
        return raw.select("iata_code", "name", "municipality", "state", "iso_country")
    return airport_lookup(raw, raw.select("iata_code").where("iata_code IS NOT NULL"))


def rebuild(spark: SparkSession, sf_dir: str, out: str, csv_dir: str | None = None,
            strict: bool = False, publish_dir: str | None = None) -> dict[str, str]:
    """Build every table from the driver tables; see :func:`rebuild_streams`."""
    return rebuild_streams(spark, view_streams(spark, sf_dir), out, csv_dir, strict, publish_dir)


def rebuild_from_csv(spark: SparkSession, folder: str, airports: DataFrame, web_drop: tuple[str, str, str], out: str,
                     csv_dir: str | None = None, strict: bool = False, publish_dir: str | None = None) -> dict[str, str]:
    """Build every table from a folder of raw CSV extracts."""
    return rebuild_streams(spark, csv_streams(spark, folder, airports, web_drop), out, csv_dir, strict, publish_dir)


def rebuild_streams(spark: SparkSession, raw: Streams, out: str, csv_dir: str | None = None,
                    strict: bool = False, publish_dir: str | None = None) -> dict[str, str]:
    """Build every table under ``out``; returns table name -> path.  With
    ``csv_dir``, the published tables are also exported as sorted CSV; with
    ``publish_dir``, facts and dimensions are copied there and verified (K3).
    Rows in, rows out, date range and actions of all steps are kept in
    ``step_metrics`` (K4).  With ``strict``, a failed
    quality check raises (after the check rows are written), like the
    reference's raising date-range assertion."""
    out = out.rstrip("/")
    paths: dict[str, str] = {}
    steps: list[Step] = []

    def save(name: str, made: DataFrame | Callable[[DataFrame], DataFrame], by_month: str | None = None, source: DataFrame | None = None, actions: str = "") -> None:
        """Write a table; ``made`` may be a function of the one ``source`` whose rows count as rows in."""
        step = Step(name, "date", actions)
        df = made if source is None else made(step.into(source))
        write_table(step.out(df), f"{out}/{name}", by_month=by_month)
        steps.append(step)
        paths[name] = f"{out}/{name}"

    # lookup + dimensions
    save("airport_lookup", raw.airports)
    read = _reader(spark, out)
    clean = facts.ecommerce_clean(raw.transactions)
    # facts: one cleaned transaction frame feeds two tables (K2); the daily one is built from the written line items
    paths.update(write_outputs(clean, "transactions_clean", {"fact_ecommerce_transactions": facts.ecommerce_transactions,
                                                             "fact_ecommerce_daily": facts.ecommerce_daily}, out, by_month="date", steps=steps))
    tag, first_day, last_day = raw.web_drop
    save("fact_web_analytics_events", lambda web: facts.web_events(web, "_source", *raw.web_drop), "date", raw.web,
         f"dropped rows of {tag} from {first_day} to {last_day}")
    save("fact_web_analytics_daily", facts.web_daily, "date", read("fact_web_analytics_events"), "grouped by day and session attributes")
    save("fact_paid_social_daily", facts.paid_social_daily, "date", raw.paid, "resolved drifted columns, grouped by day and campaign")
    save("fact_organic_social_daily", facts.organic_daily, "date", raw.posts, "grouped by day")
    save("fact_podcast_daily", facts.podcast_daily, "date", raw.mentions, "grouped by day, show and episode")
    save("fact_ooh_daily", lambda weekly: facts.ooh_daily(weekly, read("airport_lookup")), "date", raw.ooh_weekly, "added states, spread weeks over days")
    save("ooh_daily_totals", facts.ooh_daily_totals(raw.ooh_weekly))
    save("dim_date", dims.date_dim_for(read("transactions_clean"), "date"))
    save("dim_geography", dims.geography_dim([read(n).select("dma_name", "state") for n in (
        "fact_paid_social_daily", "fact_web_analytics_events", "transactions_clean")], raw.ooh_weekly, read("airport_lookup"), raw.mentions))
    save("dim_channel", dims.channel_dim(spark))
    save("dim_campaign_initiative", dims.initiative_dim(spark))
    save("dim_podcast", dims.show_dim(raw.mentions))

    # marts from the written tables
    save("cross_channel_daily", marts.cross_channel_daily(
        read("dim_date"), read("fact_paid_social_daily"), read("fact_web_analytics_daily"),
        read("fact_ecommerce_daily"), read("fact_organic_social_daily"), read("fact_podcast_daily"),
        read("ooh_daily_totals")))
    daily = read("cross_channel_daily")
    save("lag_correlations", marts.lag_correlations(daily))
    save("lag_correlations_resid", marts.lag_correlations(daily, residual=True))
    save("seasonal_inflation_summary", seasonal_inflation(read("lag_correlations"), read("lag_correlations_resid")))
    save("partial_correlation_paid_to_revenue", marts.partial_correlation(daily))
    save("promo_impact_summary", marts.promo_impact(read("fact_ecommerce_transactions")))
    save("season_summary", marts.season_summary(daily))

    # quality rows over the written tables, each read once
    suite = Suite().dated(dim_date="date", transactions_clean="date", **{n: "date" for n in (*DAILY_FACTS, "fact_web_analytics_events")})
    for n, keys in wh.GRAINS.items():
        suite.grain(n, keys)
    for n in DAILY_FACTS:
        suite.date_range(n, "dim_date").filled(n)
    (suite.formula("fact_ecommerce_transactions", "fact_ecommerce_transactions")
     .expected("fact_ecommerce_transactions", ("fact_ecommerce_transactions", COUNT), ("transactions_clean", COUNT))
     .totals("fact_ecommerce_daily", ("transactions_clean", total("line_revenue")), ("fact_ecommerce_daily", total("gross_revenue")))
     .alignment("fact_ecommerce_daily", "transactions_clean", "fact_ecommerce_daily", [
         ("revenue", total("line_revenue"), total("gross_revenue")), ("quantity", total("quantity"), total("total_quantity")), ("line_items", COUNT, total("line_items"))])
     .alignment("fact_web_analytics_daily", "fact_web_analytics_events", "fact_web_analytics_daily", [("pageviews", COUNT, total("pageviews"))]))
    checks = (dq.check_paths_exist(spark, {n: p for n, p in paths.items() if n.startswith(("fact_", "dim_"))})
              .unionByName(suite.rows(spark, read)))
    save("quality_checks", checks)
    save("quality_summary", dq.suite_summary(read("quality_checks")))
    if strict:
        # at most one row per check reaches the driver
        failed = read("quality_checks").where(F.col("status") == "FAIL").collect()
        if failed:
            raise ValueError("quality checks failed: " + "; ".join(
                f"{r.check}/{r.table_name}: {r.detail}" for r in failed))
    if csv_dir:
        export_csv(spark, paths, csv_dir)
    if publish_dir:
        publish(spark, [(p, f"{publish_dir.rstrip('/')}/{n}") for n, p in paths.items() if n.startswith(("fact_", "dim_"))])
    write_table(step_metrics(spark, steps).coalesce(1), f"{out}/step_metrics")
    paths["step_metrics"] = f"{out}/step_metrics"
    return paths
