"""No row is lost and no value decides from a part of the table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline import session
from martline.operators import drift, joins, overlap
from martline.operators.quantiles import exact_median, surrogate_key
from martline.plans import explore, profile
from martline.plans import quality as dq


def test_overlap_removal_keeps_rows_without_a_date(spark):
    df = spark.createDataFrame([("b", dt.datetime(2024, 1, 16)), ("b", None), ("a", dt.datetime(2024, 1, 16)), (None, dt.datetime(2024, 1, 16)), ("b", dt.datetime(2024, 2, 1))],
                               "src string, ts timestamp_ntz")
    kept = overlap.drop_overlap(df, "src", "b", "ts", "2024-01-15", "2024-01-20").collect()
    assert sorted((r.src or "", str(r.ts)) for r in kept) == [("", "2024-01-16 00:00:00"), ("a", "2024-01-16 00:00:00"), ("b", "2024-02-01 00:00:00"), ("b", "None")]


def test_period_without_start_keeps_its_flow(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 7.0), (None, 14.0)], "start date, spend double")
    out = overlap.expand_period(df, "start", 7, ["spend"])
    assert out.count() == 8 and out.agg(F.sum("spend")).first()[0] == 21.0
    assert out.where("date IS NULL").first().spend == 14.0


def test_tagged_drift_keeps_an_already_renamed_value(spark):
    df = spark.createDataFrame([("instagram_part3.csv", 5.0, None), ("instagram_part3.csv", None, 2.0), ("tiktok_part1.csv", 3.0, 9.0)], "f string, spend double, spend_usd double")
    target = T.StructType([T.StructField("spend", T.DoubleType())])
    got = drift.resolve_drift_tagged(df, "f", drift.PAID_DRIFT_RULES, target)
    assert sorted(r.spend for r in got.collect()) == [2.0, 3.0, 5.0]


def test_one_late_value_decides_a_date_column(spark):
    days = [("2024-01-01", "2024-01-01 10:00:00", None)] * 5000
    df = spark.createDataFrame(days + [("2024-01-02", "no date", None)], "a string, b string, c string").coalesce(1)
    assert {r.column_name: (r.non_null, r.is_date) for r in profile.detect_date_columns(df).collect()} == {"a": (5001, True), "b": (5001, False), "c": (0, False)}


def test_totals_are_exact_and_include_the_tolerance(spark):
    cents = spark.range(200_000).select(F.lit(0.1).alias("v"))
    total = spark.createDataFrame([(20000.0,)], "v double")
    off = lambda x: spark.createDataFrame([(x,)], "v double")
    got = {r.table_name: r.status for r in dq.check_totals({
        "many": (cents, "v", total, "v"), "edge": (total, "v", off(20000.01), "v"), "over": (total, "v", off(20000.02), "v"),
        "empty": (total, "v", total.limit(0), "v")}).collect()}
    assert got == {"many": "PASS", "edge": "PASS", "over": "FAIL", "empty": "FAIL"}


def test_alignment_of_a_table_with_itself_passes_with_null_keys(spark):
    t = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 3.0)], "k string, v double")
    assert {r.status for r in dq.check_alignment("t", t, t, "k", [("v", F.sum("v"), F.sum("v"))]).collect()} == {"PASS"}
    assert {r.status for r in dq.check_alignment("t", t, t.where("v < 3"), "k", [("v", F.sum("v"), F.sum("v"))]).collect()} == {"FAIL"}


def test_null_group_has_its_median(spark):
    rows = [("a", float(v)) for v in range(7)] + [(None, 1.0), (None, 3.0), (None, 900.0), ("neg", -5.0), ("neg", 4.0), ("z", None),
                                                 ("inf", float("inf")), ("inf", 2.0), ("inf", float("-inf"))]
    df = spark.createDataFrame(rows, "g string, v double")
    assert {r.g: r.median for r in exact_median(df, ["g"], "v").collect()} == {"a": 3.0, None: 3.0, "neg": -0.5, "inf": 2.0}
    dist = {r.g: r.median for r in explore.metric_distribution(df.where("g IS NULL OR g = 'a'"), "g", "v").collect()}
    assert dist == {"a": 3.0, None: 3.0}


def test_keys_and_medians_run_no_job_while_planning(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"), (F.col("id") % 3).alias("g"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        exact_median(df, ["g"], "v")
        surrogate_key(df, ["v"], "k")
        assert not tracker.getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_shared_keys_across_three_files(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [("a", day, "k1", 1), ("b", day, "k1", 1), ("c", day, "k1", 2), ("a", day, "k2", 1), ("a", None, None, 1), ("b", None, None, 1)]
    df = spark.createDataFrame(rows, "f string, d timestamp_ntz, k string, v int")
    got = {(r.file_a, r.file_b): (r.shared_keys, r.identical_rows, r.shared_dates) for r in explore.overlap_keys(df, "f", ["k"], "d").collect()}
    assert got == {("a", "b"): (2, 2, 1), ("a", "c"): (1, 0, 1), ("b", "c"): (1, 0, 1)}


def test_overlaps_only_within_a_stream_and_with_gaps(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    rows = [("s", "a", day(1)), ("s", "a", day(10)), ("s", "b", day(5)), ("s", "b", day(6)), ("t", "c", day(5)), ("s", "d", day(20)), ("s", "e", None)]
    got = profile.overlap_report(spark.createDataFrame(rows, "st string, f string, ts timestamp_ntz"), "f", "ts", ["st"]).collect()
    assert [(r.st, r.file_a, r.file_b, str(r.overlap_start), str(r.overlap_end), r.rows_a, r.rows_b) for r in got] == [("s", "a", "b", "2024-01-05", "2024-01-06", 0, 2)]


def test_substring_pairs_only_make_lengths_of_the_other_side(spark):
    a = spark.createDataFrame([("BTS 2023",), ("abc",), (None,), ("",)], "x string")
    b = spark.createDataFrame([("Instagram bts 2023",), ("B",), ("abc",)], "y string")
    pairs = {(r.left_value, r.right_value) for r in joins.substring_pairs(a, "x", b, "y").collect()}
    assert pairs == {("BTS 2023", "Instagram bts 2023"), ("BTS 2023", "B"), ("abc", "B")}


def test_geographic_terms_and_columns(spark):
    m = spark.createDataFrame([("GA Hour", "e1", 1), ("GA Hour", "e1", 1), ("GA Hour", "e2", 0), ("gaga", "e", 0), ("Peach State of georgia", None, 1), (None, "e", 1)],
                              "podcast_name string, episode_title string, mentions_founder int")
    terms = spark.createDataFrame(list(explore.GEO_TERMS), "kind string, term string, mode string")
    got = {r.podcast_name: (r.mentions, r.founder_episodes, r.geo_terms) for r in explore.geo_signals(m, terms).collect()}
    assert got == {"GA Hour": (3, 1, "abbrev:GA"), "gaga": (1, 0, None), "Peach State of georgia": (1, 1, "regional:Peach State,state:Georgia")}
    t = {"x": spark.createDataFrame([], "platform string, latency int, location string, zip_code string")}
    assert explore.geo_columns(t) == [("x", "location"), ("x", "zip_code")]


def test_streams_are_told_apart_on_two_levels(spark):
    names = ["website_transactions_2024.csv", "unpaid_orders.csv", "paid_instagram_part1.csv", "paid_pinterest.csv", "web_traffic_1.csv"]
    df = spark.createDataFrame([(n,) for n in names], "f string").withColumn("s", profile.classify_stream("f"))
    got = [(r.s, r.g) for r in df.withColumn("g", profile.stream_group("s")).collect()]
    assert got == [("transactions", "ecommerce"), ("unknown", "unknown"), ("paid_instagram", "paid_social"), ("paid_pinterest", "paid_social"), ("web_traffic", "web_analytics")]
    assert [s for s, _ in got] == [profile.stream_of_name(n) for n in names]


def test_a_rewritten_table_is_read_anew(spark, tmp_path):
    import os
    import shutil
    import __spark_entry__ as entry
    from conftest import SF_SMALL
    d = tmp_path / "sf"
    d.mkdir()
    for f in os.listdir(SF_SMALL):
        shutil.copy(f"{SF_SMALL}/{f}", d / f) if f != "events.parquet" else None
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.limit(100).write.parquet(str(d / "events.parquet"))
    q = entry.queries()
    assert q["web_events_dedup"](spark, str(d)).count() == 100
    before = q["show_dim"](spark, str(d)).count()
    events.write.mode("overwrite").parquet(str(d / "events.parquet"))
    assert q["web_events_dedup"](spark, str(d)).count() == events.count()
    assert q["show_dim"](spark, str(d)).count() >= before


class _Context:
    def __init__(self, master, held=None):
        self.master, self.held = master, held

    def getCheckpointDir(self):
        return self.held

    def setCheckpointDir(self, path):
        self.held = path + "/x"


class _Session:
    def __init__(self, master, conf=None, held=None):
        self.sparkContext, self.conf = _Context(master, held), {"spark.checkpoint.dir": conf} if conf else {}


def test_no_local_checkpoint_folder_on_a_cluster(tmp_path):
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.ensure_checkpoint_dir(_Session(master))
    assert session.ensure_checkpoint_dir(_Session("yarn", conf="hdfs://x/ck")) == "hdfs://x/ck"
    held = _Session("yarn", held="hdfs://own/123")
    assert session.ensure_checkpoint_dir(held) == "hdfs://own/123" and held.sparkContext.held == "hdfs://own/123"
    assert session.ensure_checkpoint_dir(_Session("local[2]"))


def test_texts_without_a_layouts_punctuation_are_not_parsed_and_others_are(spark):
    texts = ["2024-01-02", "2024-01-02 03:04:05", "2024-01-02T03:04:05", "2024-01-02 03:04:05.123456", "01/02/2024", "", "-", "-- ::", "/", "1-2-3",
             "ECONOMY STEEL", "T-SHIRT", "12345", "2024/01/02", " 2024-01-02", "2024-01-02 ", "2024-01-0212:00:00", "+12024-01-02", None]
    formats = (*profile.DATE_FORMATS, "yyyyMMdd", "yyyy[-MM]", "d MMM yyyy")
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    plain = F.coalesce(*[F.try_to_timestamp("s", F.lit(f)) for f in formats])
    assert df.where(~profile.parse_any(F.col("s"), formats).eqNullSafe(plain)).count() == 0
    assert profile.layout_marks("yyyy-MM-dd'T'HH:mm:ss") == ["-", ":"] and profile.layout_marks("yyyy[-MM]") == [] == profile.layout_marks("yyyyMMdd")
    plan = profile.detect_date_columns(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("contains") >= len(profile.DATE_FORMATS)
