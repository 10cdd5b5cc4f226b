"""End-to-end goldens from the reference checkout's data files (read only; skipped when absent)."""

import csv
import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import REFERENCE
from martline.plans import dims, facts
from martline.sources.files import read_source

needs = pytest.mark.skipif(not os.path.isdir(REFERENCE), reason="reference checkout not present")


def csvs_with_header(*columns):
    """CSV files under the reference checkout whose header starts with ``columns``
    (found by content, so no file name is hard-coded); one per distinct content."""
    found, seen = [], set()
    for root, _, names in os.walk(REFERENCE):
        if "/.git" in root:
            continue
        for n in sorted(names):
            if not n.endswith(".csv"):
                continue
            p = os.path.join(root, n)
            with open(p, encoding="utf-8") as f:
                head = f.readline().strip().split(",")
                body = f.read()
            if head[:len(columns)] == list(columns) and body not in seen:
                seen.add(body)
                found.append(p)
    return sorted(found)


PODCAST_SCHEMA = T.StructType([
    T.StructField("podcast_name", T.StringType()), T.StructField("episode_title", T.StringType()),
    T.StructField("episode_release_date", T.DateType()), T.StructField("mention_datetime", T.TimestampNTZType()),
    T.StructField("host_name", T.StringType()), T.StructField("mentions_brand", T.IntegerType()),
    T.StructField("mentions_founder", T.IntegerType()), T.StructField("transcript_snippet", T.StringType()),
    T.StructField("estimated_impressions", T.LongType()), T.StructField("episode_rating", T.DoubleType()),
    T.StructField("sentiment", T.StringType())])

ORGANIC_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("post_id", T.StringType()),
    T.StructField("caption", T.StringType())] + [T.StructField(c, T.LongType()) for c in
    ("followers", "impressions", "video_views", "video_completes", "likes", "comments", "shares", "clicks", "saves")])


def read_golden(path):
    with open(path, newline="", encoding="utf-8") as f:
        return list(csv.DictReader(f))


@needs
def test_podcast_rollup_equals_golden(spark):
    files = csvs_with_header("podcast_name", "episode_title", "episode_release_date", "mention_datetime")
    raw = read_source(spark, files, PODCAST_SCHEMA)
    out = facts.podcast_daily(raw).collect()
    gold = read_golden(csvs_with_header("date", "podcast_name", "episode_title", "host_name")[0])
    assert len(out) == len(gold) == 85
    got = {(str(r.date), r.podcast_name, r.episode_title): r for r in out}
    for g in gold:
        r = got[(g["date"], g["podcast_name"], g["episode_title"])]
        assert r.host_name == g["host_name"] and r.sentiment == g["sentiment"]
        assert r.mentions_brand == int(g["mentions_brand"]) and r.mentions_founder == int(g["mentions_founder"])
        assert r.estimated_impressions == int(g["estimated_impressions"]) and r.mentions == int(g["mentions"])
        assert math.isclose(r.episode_rating, float(g["episode_rating"]))


@needs
def test_organic_rollup_equals_golden_for_2024(spark):
    raw = read_source(spark, csvs_with_header("date", "post_id", "caption", "followers"), ORGANIC_SCHEMA)
    out = {str(r.date): r for r in facts.organic_daily(raw).collect()}
    gold = [g for g in read_golden(csvs_with_header("date", "posts", "followers_eod")[0])
            if g["date"] >= "2024-01-01"]
    assert len(out) == len(gold) == 143
    for g in gold:
        r = out[g["date"]]
        for c in ("posts", "followers_eod", "impressions", "video_views", "video_completes", "likes", "comments",
                  "shares", "clicks", "saves"):
            assert getattr(r, c) == int(g[c]), (g["date"], c)


def test_season_days_on_reference_calendar(spark):
    dd = dims.date_dim(spark, "2023-01-01", "2024-06-30")
    got = {r.season_flag: r["count"] for r in dd.groupBy("season_flag").count().collect()}
    assert got == {"regular": 458, "back_to_school": 63, "black_friday_holiday": 26}
    assert sum(got.values()) == dd.count() == 547
    row = dd.where("date = date'2024-06-30'").collect()[0]
    assert (row.day_of_week, row.day_of_week_num, str(row.week_start_date), row.is_weekend) == \
        ("Sunday", 7, "2024-06-24", True)


@needs
def test_seasonal_inflation_and_semi_partial_from_committed_correlations(spark):
    from martline.operators.stats import seasonal_inflation
    schema = T._parse_datatype_string("signal_pair string, lag_days int, pearson_r double")
    gold = {g["signal_pair"]: g for g in read_golden(csvs_with_header("signal_pair", "raw_r", "residual_r")[0])}
    # the two lag tables: the raw one is the one whose lag-0 values are the golden raw_r
    lags = [read_source(spark, p, schema, source_col=None) for p in csvs_with_header("signal_pair", "lag_days", "pearson_r")]
    lag0 = [{r.signal_pair: r.pearson_r for r in t.where("lag_days = 0").collect()} for t in lags]
    raw_i = next(i for i, m in enumerate(lag0) if all(math.isclose(m[k], float(g["raw_r"])) for k, g in gold.items()))
    raw, res = lags[raw_i], lags[1 - raw_i]
    infl = {r.signal_pair: r for r in seasonal_inflation(raw, res).collect()}
    assert set(infl) == set(gold)
    for k, g in gold.items():
        assert math.isclose(infl[k].percent_reduction, float(g["percent_reduction"]), abs_tol=1e-6)
    # semi-partial closed form from the three lag-0 residual correlations (s=spend, y=revenue, x=sessions)
    r0 = {r.signal_pair: r.pearson_r for r in res.where("lag_days = 0").collect()}
    def pick(*words):
        return next(v for k, v in r0.items() if all(w in k for w in words))
    r_sx = pick("Spend", "Sessions")
    r_sy = pick("Spend", "Revenue")
    r_xy = pick("Sessions", "Revenue")
    semi = (r_sy - r_sx * r_xy) / math.sqrt(1 - r_xy ** 2)
    gold_p = read_golden(csvs_with_header("simple_corr", "partial_corr")[0])[0]
    assert round(semi, 6) == float(gold_p["partial_corr"])


def _rows(path):
    return read_golden(path)


@needs
def test_constant_dimensions_equal_published_tables(spark):
    from martline.plans.dims import channel_dim, initiative_dim
    gold_ch = _rows(csvs_with_header("channel_key", "channel_name", "channel_group", "is_paid")[0])
    got_ch = channel_dim(spark).orderBy("channel_key").collect()
    assert [(str(r.channel_key), r.channel_name, r.channel_group, str(r.is_paid)) for r in got_ch] == \
        [(g["channel_key"], g["channel_name"], g["channel_group"], g["is_paid"]) for g in gold_ch]
    gold_in = _rows(csvs_with_header("initiative_key", "initiative_name")[0])
    got_in = initiative_dim(spark).orderBy("initiative_key").collect()
    assert [(str(r.initiative_key), r.initiative_name, r.paid_social_campaign_pattern or "",
             r.web_analytics_campaign_value or "", r.notes) for r in got_in] == \
        [(g["initiative_key"], g["initiative_name"], g["paid_social_campaign_pattern"],
          g["web_analytics_campaign_value"], g["notes"]) for g in gold_in]


@needs
def test_show_and_inferred_geography_from_raw_mentions(spark):
    from martline.plans.dims import geography_dim, show_dim
    raw = read_source(spark, csvs_with_header("podcast_name", "episode_title", "episode_release_date"), PODCAST_SCHEMA)
    gold = _rows(csvs_with_header("podcast_key", "podcast_name", "geo_inferred", "geo_state")[0])
    got = show_dim(raw).orderBy("podcast_key").collect()
    assert [(str(r.podcast_key), r.podcast_name, r.geo_inferred, r.geo_state or "") for r in got] == \
        [(g["podcast_key"], g["podcast_name"], g["geo_inferred"], g["geo_state"]) for g in gold]
    # the inferred scope of the geography dimension: one row per show, GA or unknown, in name order
    empty_local = spark.createDataFrame([], "dma_name string, state string")
    empty_ooh = spark.createDataFrame([], "week_start_date date, airport_code string, airport_name string")
    empty_lookup = spark.createDataFrame([], "iata_code string, name string, state string")
    geo = geography_dim([empty_local], empty_ooh, empty_lookup, raw).orderBy("geo_key").collect()
    gold_geo = [g for g in _rows(csvs_with_header("geo_key", "dma_name", "state", "zip_code")[0])
                if g["geo_scope"] == "inferred"]
    assert [(r.state or "", r.geo_scope) for r in geo] == [(g["state"], g["geo_scope"]) for g in gold_geo]
