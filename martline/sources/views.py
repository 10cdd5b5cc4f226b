"""Domain views over the driver's synthetic tables.

The reference reads 21 marketing CSVs that are not available; these views
derive tables of the same shape from ``lineitem / orders / customer / part /
supplier / nation / region / events`` so every operator runs over data whose
size grows with the scale factor.  All definitions are plain projections,
joins and aggregates, so Catalyst prunes columns and pushes filters down to
the parquet scans.  The DuckDB oracle in ``oracle_queries.py`` restates each
view in SQL.

Mapping (see SURVEY §7.3):

* v_txn          ecommerce line items  <- lineitem x orders x customer x nation x region x part
* v_web(_a/_b)   web page views (two overlapping extracts) <- events
* v_posts        organic posts         <- events
* v_mentions     podcast mentions      <- events
* paid_parts     nine paid-social extracts with schema drift <- lineitem x nation x region
* v_ooh_weekly   weekly airport OOH    <- lineitem x supplier
* airports_raw   open airport list     <- supplier x nation

Key arithmetic (``x % n``) in these views only derives attributes (a
channel, a market, a campaign) from keys; no view drops rows by key
arithmetic, so every query reads the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.session import per_session

from martline.functions.numeric import MONEY
from martline.operators.joins import sized_join
from martline.operators.rollup import dealt

# Fixed values of the synthetic mapping (not reference data):
# the event stream is moved back by this many days so that it lands inside
# the lineitem calendar (2024-01-01 -> 1998-01-01).
EVENT_SHIFT_DAYS = 9496
# web extracts: A covers events before WEB_A_END, B from WEB_B_START (6-day overlap)
WEB_A_END = "1998-01-21"
WEB_B_START = "1998-01-15"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's parquet table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region: 25 rows in every TPC-H scale (fixed size -> broadcast)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return F.broadcast(n.join(r, n.n_regionkey == r.r_regionkey)
                       .select("n_nationkey", F.col("n_name").alias("dma_name"),
                               F.col("r_name").alias("state")))


def _packed(df: DataFrame, *apart: str) -> DataFrame:
    """All columns but ``apart`` in one value: plans that need different parts of it still make the same shuffle, once."""
    return df.select(*apart, F.array(F.struct(*[c for c in df.columns if c not in apart])).alias("_packed"))


def _unpacked(df: DataFrame) -> DataFrame:
    parts = df.schema["_packed"].dataType.elementType.names
    return df.select(*[c for c in df.columns if c != "_packed"], *[F.element_at("_packed", 1)[c].alias(c) for c in parts])


# --------------------------------------------------------------------- ecommerce
@per_session
def v_txn(spark: SparkSession, sf_dir: str, shared: bool = False) -> DataFrame:
    """Ecommerce transaction lines (raw stream of T4/T5), money as DECIMAL(18,2).

    ``shared`` keeps all columns up to the last shuffle, so that tables built
    from it within one plan share the joins, whichever columns they use.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    geo = _geo(spark, sf_dir)
    promo = F.col("l_discount") >= F.lit(0.05)
    price = F.col("p_retailprice").cast(MONEY)
    disc = F.when(promo, (F.col("l_discount") * 10000).cast(MONEY)).otherwise(F.lit(0).cast(MONEY))
    qty = F.col("l_quantity").cast("bigint")
    # Enrich orders with the customer first (orders-sized join), so the
    # lineitem-sized data is shuffled only for the order and the part joins.
    # The market's names are attached after them: shuffles carry its key.
    oc = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_custkey", "c_nationkey")
    # An order has few lines; dealt by order, a task's share does not grow with the table.
    li = dealt(li, ["l_orderkey"])
    df = li.join(oc, li.l_orderkey == oc.o_orderkey).drop("o_orderkey")
    df = (_unpacked(_packed(df, "l_partkey").join(p, F.col("l_partkey") == p.p_partkey)) if shared else df.join(p, li.l_partkey == p.p_partkey))
    df = df.join(geo, F.col("c_nationkey") == geo.n_nationkey)
    return df.select(
        F.to_date("l_shipdate").alias("date"),
        F.col("l_shipdate").alias("order_datetime"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        "dma_name", "state",
        F.lpad((F.col("o_custkey") % 100000).cast("string"), 5, "0").alias("zip_code"),
        F.col("p_type").alias("product_category"),
        F.when(F.col("p_size") <= 12, "XS").when(F.col("p_size") <= 25, "S")
         .when(F.col("p_size") <= 37, "M").otherwise("L").alias("size"),
        qty.alias("quantity"),
        price.alias("unit_price"),
        (price - F.lit(250).cast(MONEY)).cast(MONEY).alias("unit_cost"),
        disc.alias("discount_per_unit"),
        (qty.cast("decimal(18,0)") * (price - disc)).cast(MONEY).alias("line_revenue"),
        promo.cast("int").alias("promo_flag"),
    )


# --------------------------------------------------------------------- events
@per_session
def events_shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        (F.col("ts") - F.expr(f"INTERVAL {EVENT_SHIFT_DAYS} DAYS")).alias("ts"),
        "user_id", "event_type", "value", "props",
        F.regexp_extract("props", r"(\d+)", 1).try_cast("int").alias("k"),
    )


@per_session
def v_web(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page views once (the clean event stream)."""
    e = events_shifted(spark, sf_dir)
    geo = _geo(spark, sf_dir)
    d = F.to_date("ts")
    df = e.join(geo, (e.user_id % 25) == geo.n_nationkey)
    return df.select(
        d.alias("date"),
        F.col("ts").alias("event_datetime"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format(d, "yyyyMMdd")).alias("session_id"),
        F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), F.col("k").cast("string")).alias("page_url"),
        F.when(F.col("event_type") == "click", "instagram").when(F.col("event_type") == "view", "google")
         .when(F.col("event_type") == "signup", "email").when(F.col("event_type") == "purchase", "direct")
         .otherwise("partner").alias("traffic_source"),
        F.when(F.col("k") % 3 == 0, "cpc").when(F.col("k") % 3 == 1, "organic")
         .otherwise("referral").alias("traffic_medium"),
        F.when(F.col("k") % 6 == 1, "Always On").when(F.col("k") % 6 == 2, "BTS 2023")
         .when(F.col("k") % 6 == 3, "BTS 2024").when(F.col("k") % 6 == 4, "Black Friday 2023")
         .when(F.col("k") % 6 == 5, "Email Promo").alias("campaign"),
        F.when(F.col("user_id") % 3 == 0, "desktop").when(F.col("user_id") % 3 == 1, "mobile")
         .otherwise("tablet").alias("device_category"),
        "dma_name", "state",
        F.lpad(((F.col("user_id") * 37) % 100000).cast("string"), 5, "0").alias("zip_code"),
    )


@per_session
def v_web_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping extracts of the web stream, tagged in ``_source``.

    One scan: each event is emitted once per extract whose period covers it
    (twice inside the overlap window).
    """
    w = v_web(spark, sf_dir)
    ts = F.col("event_datetime")
    tags = F.array_compact(F.array(F.when(ts < F.lit(WEB_A_END).cast("timestamp_ntz"), F.lit("web_a")),
                                   F.when(ts >= F.lit(WEB_B_START).cast("timestamp_ntz"), F.lit("web_b"))))
    return w.withColumn("_source", F.explode(tags))


@per_session
def v_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organic social posts."""
    e = events_shifted(spark, sf_dir)
    return e.select(
        F.to_date("ts").alias("date"),
        F.col("user_id").cast("string").alias("post_id"),
        F.concat(F.lit("post "), F.col("event_type")).alias("caption"),
        F.round(F.col("value") * 100).cast("bigint").alias("followers"),
        F.round(F.col("value") * 1000).cast("bigint").alias("impressions"),
        (F.col("k") * 10).cast("bigint").alias("video_views"),
        F.col("k").cast("bigint").alias("video_completes"),
        (F.col("event_id") % 50).alias("likes"),
        (F.col("event_id") % 7).alias("comments"),
        (F.col("event_id") % 11).alias("shares"),
        F.when(F.col("event_type") == "click", 1).otherwise(0).cast("bigint").alias("clicks"),
        (F.col("k") % 4).cast("bigint").alias("saves"),
    )


# Fixed values of the synthetic mapping: show names per event type.  Three
# carry a geographic keyword, two do not.
SHOW_BY_EVENT = (
    ("click", "Morning Drive GA"),
    ("view", "Inside the ATL Hour"),
    ("signup", "Peach State Weekly"),
    ("purchase", "Coastal Living Talk"),
    ("error", "Trendline Radio"),
)


@per_session
def v_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Podcast mentions."""
    e = events_shifted(spark, sf_dir)
    show = None
    for ev, name in SHOW_BY_EVENT:
        show = F.when(F.col("event_type") == ev, name) if show is None else show.when(F.col("event_type") == ev, name)
    return e.select(
        show.alias("podcast_name"),
        F.concat(F.lit("Episode "), F.col("user_id").cast("string")).alias("episode_title"),
        F.date_sub(F.to_date("ts"), (F.col("user_id") % 3).cast("int")).alias("episode_release_date"),
        F.col("ts").alias("mention_datetime"),
        F.concat(F.lit("host_"), (F.col("event_id") % 7).cast("string")).alias("host_name"),
        F.when(F.col("value") >= 25, 1).otherwise(0).alias("mentions_brand"),
        (F.col("event_id") % 2).cast("int").alias("mentions_founder"),
        F.col("props").alias("transcript_snippet"),
        F.round(F.col("value") * 1000).cast("bigint").alias("estimated_impressions"),
        ((F.col("k") % 50).cast("double") / 10).alias("episode_rating"),
        F.when(F.col("value") < 10, "negative").when(F.col("value") < 30, "neutral")
         .otherwise("positive").alias("sentiment"),
    )


# --------------------------------------------------------------------- paid social
# Fixed values of the synthetic mapping: platforms and campaign themes.
PLATFORMS = ("Instagram", "Pinterest", "TikTok")
THEMES = ("Always On", "BTS Moms", "Teen Trends")
GOALS = ("awareness", "conversions", "traffic")


@per_session
def paid_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undrifted paid-social table at its grain (date, channel, campaign_id, dma_name).

    Rows are grouped by the small integer codes the labels derive from
    (channel, theme, market); the label strings and the 25-row market table
    are attached after aggregation, so the per-row work and the shuffle keys
    stay narrow.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    geo = _geo(spark, sf_dir)
    g = li.select(F.to_date("l_shipdate").alias("date"), (F.col("l_suppkey") % 3).cast("int").alias("_ch"),
                  (F.col("l_partkey") % 3).cast("int").alias("_th"), (F.col("l_orderkey") % 25).alias("_nk"),
                  F.col("l_extendedprice").cast(MONEY).alias("_spend"), "l_quantity", "l_linenumber")
    agg = (g.groupBy("date", "_ch", "_th", "_nk")
           .agg(F.sum("_spend").alias("spend"),
                (F.sum("l_quantity").cast("bigint") * 100).alias("impressions"),
                F.count(F.lit(1)).alias("clicks"),
                F.sum("l_linenumber").cast("bigint").alias("video_views"),
                F.count_if(F.col("l_linenumber") >= 2).alias("video_25pct"),
                F.count_if(F.col("l_linenumber") >= 3).alias("video_50pct"),
                F.count_if(F.col("l_linenumber") >= 4).alias("video_75pct"),
                F.count_if(F.col("l_linenumber") >= 5).alias("video_completes")))
    ch, th = F.col("_ch"), F.col("_th")
    channel = F.when(ch == 0, PLATFORMS[0]).when(ch == 1, PLATFORMS[1]).otherwise(PLATFORMS[2])
    theme = F.when(th == 0, THEMES[0]).when(th == 1, THEMES[1]).otherwise(THEMES[2])
    goal = F.when(th == 0, GOALS[0]).when(th == 1, GOALS[1]).otherwise(GOALS[2])
    out = agg.join(geo, agg._nk == geo.n_nationkey).select(
        "date", channel.alias("channel"),
        F.concat(channel, F.lit(" "), theme).alias("campaign_name"),
        F.concat(F.upper(F.substring(channel, 1, 2)), F.lit("_"), (th + 1001).cast("string")).alias("campaign_id"),
        "dma_name", "state", goal.alias("optimization_goal"),
        "spend", "impressions", "clicks", "video_views", "video_25pct", "video_50pct", "video_75pct",
        "video_completes")
    return (out.withColumn("age_target", F.lit("25-44"))
            .withColumn("audience_segment",
                        F.when(F.col("campaign_name").contains("Teen"), "teens").otherwise("parents"))
            .withColumn("_file", F.concat(F.lower("channel"), F.lit("_part"),
                                          ((F.year("date") % 3) + 1).cast("string"))))


PAID_FILES = tuple(f"{p.lower()}_part{i}" for p in PLATFORMS for i in (1, 2, 3))
PAID_STANDARD = ("date", "channel", "campaign_name", "campaign_id", "dma_name", "state", "optimization_goal",
                 "spend", "impressions", "clicks", "video_views", "video_25pct", "video_50pct", "video_75pct",
                 "video_completes", "age_target", "audience_segment")
# Fixed values of the synthetic mapping: the three drifted extracts
# (renamed columns, added columns, omitted columns).
PAID_DRIFT = {
    "instagram_part3": ({"spend": "spend_usd"}, ("spend_currency",), ()),
    "pinterest_part1": ({"clicks": "link_clicks"}, (), ("video_25pct", "video_50pct")),
    "tiktok_part2": ({"video_views": "views"}, (), ("optimization_goal",)),
}


def paid_file_columns() -> dict[str, list[str]]:
    """Header of each paid extract (schema metadata)."""
    out = {}
    for f in PAID_FILES:
        ren, add, omit = PAID_DRIFT.get(f, ({}, (), ()))
        out[f] = [ren.get(c, c) for c in PAID_STANDARD if c not in omit] + list(add)
    return out


@per_session
def paid_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine paid extracts as one frame tagged by ``_file`` with the union of
    their headers: a column holds values only on rows of extracts that have it
    (what a by-name union of the files gives).  Built in one scan."""
    base = paid_base(spark, sf_dir)
    f = F.col("_file")
    cols = {c: F.col(c) for c in PAID_STANDARD}
    for name, (ren, add, omit) in PAID_DRIFT.items():
        for old, new in ren.items():
            cols[new] = F.when(f == name, cols[old])
            cols[old] = F.when(f != name, cols[old])
        for c in omit:
            cols[c] = F.when(f != name, cols[c])
        for c in add:
            cols[c] = F.when(f == name, F.lit("USD") if c == "spend_currency" else F.lit(None))
    return base.select("_file", *[e.alias(c) for c, e in cols.items()])


def paid_parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine paid-social extracts as separate frames, each with its own header."""
    raw = paid_raw(spark, sf_dir)
    return {name: raw.where(F.col("_file") == name).select(*cols)
            for name, cols in paid_file_columns().items()}


# --------------------------------------------------------------------- OOH
@per_session
def v_ooh_weekly(spark: SparkSession, sf_dir: str, shared: bool = False) -> DataFrame:
    """Weekly airport placements at (week_start_date, airport_code, format, audience_segment).

    ``shared`` deals the weekly rows by airport with all columns, so that
    tables built from it within one plan share that shuffle, whichever they use.
    """
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # a supplier has few lines a week: they are dealt as they are, in shares that do not grow with the table
    li = li.withColumn("week_start_date", F.to_date(F.date_trunc("week", "l_shipdate"))).drop("l_shipdate")
    wk = (dealt(li, ["week_start_date", "l_suppkey"]).groupBy("week_start_date", "l_suppkey")
          .agg(F.sum(F.col("l_extendedprice").cast(MONEY)).alias("spend"),
               (F.sum("l_quantity").cast("bigint") * 1000).alias("impressions"),
               F.count(F.lit(1)).alias("placements")))
    df = sized_join(wk, s, wk.l_suppkey == s.s_suppkey)
    df = df.select(
        "week_start_date",
        F.concat(F.lit("AP"), F.col("s_suppkey").cast("string")).alias("airport_code"),
        F.concat(F.lit("Airport "), F.col("s_name")).alias("airport_name"),
        F.when(F.col("s_suppkey") % 3 == 0, "digital").when(F.col("s_suppkey") % 3 == 1, "static")
         .otherwise("spectacular").alias("format"),
        F.when(F.col("s_nationkey") % 2 == 0, "business").otherwise("leisure").alias("audience_segment"),
        "spend", "impressions", "placements")
    return _unpacked(dealt(_packed(df, "airport_code"), ["airport_code"])).select(*df.columns) if shared else df


@per_session
def airports_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open airport list: padded codes, ISO region 'US-<n>' or a bare region."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    df = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
    return df.select(
        F.concat(F.lit(" AP"), F.col("s_suppkey").cast("string"), F.lit(" ")).alias("iata_code"),
        F.concat(F.lit("Airport "), F.col("s_name")).alias("name"),
        F.lower(F.col("n_name")).alias("municipality"),  # an outside list spells names its own way
        F.when(F.col("s_suppkey") % 4 == 0, F.col("n_name"))
         .otherwise(F.concat(F.lit("US-"), F.col("n_name"))).alias("iso_region"),
        F.lit("US").alias("iso_country"))


@per_session
def all_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole airport list, trimmed and with its state (no restriction to wanted codes)."""
    from martline.sources.files import airport_lookup
    raw = airports_raw(spark, sf_dir)
    return airport_lookup(raw, raw.select("iata_code"))


@per_session
def wanted_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes the lookup is restricted to: airports of active suppliers (account
    balance not negative).  Placements at other airports keep a NULL state."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return s.filter(F.col("s_acctbal") >= 0).select(
        F.concat(F.lit("AP"), F.col("s_suppkey").cast("string")).alias("code"))
