"""Profiling and drift resolution straight from raw CSV extracts (synthetic fixtures)."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.operators.drift import resolve_drift_tagged
from martline.plans.profile import profile_files
from martline.sources.files import read_tagged

STD = "date,channel,campaign_id,spend,clicks,video_views,optimization_goal\n"


def write(path, text):
    path.write_text(text)
    return str(path)


def fixtures(tmp_path):
    files = [
        write(tmp_path / "paid_instagram_part1.csv", STD + "2024-01-01,Instagram,IG_1,10.50,3,7,awareness\n"
                                                          "2024-01-02,Instagram,IG_1,11.00,4,8,awareness\n"),
        write(tmp_path / "paid_instagram_part3.csv",
              "date,channel,campaign_id,spend_usd,spend_currency,clicks,video_views,optimization_goal\n"
              "2024-01-05,Instagram,IG_1,12.25,USD,5,9,awareness\n"),
        write(tmp_path / "paid_pinterest_part1.csv",
              "date,channel,campaign_id,spend,link_clicks,video_views,optimization_goal\n"
              "2024-01-03,Pinterest,PI_1,4.00,2,1,traffic\n"),
        write(tmp_path / "paid_tiktok_part2.csv",
              "date,channel,campaign_id,spend,clicks,views\n2024-01-04,TikTok,TT_1,6.75,1,30\n"),
        write(tmp_path / "web_traffic_early.csv",
              "event_datetime,user_id,campaign\n2024-01-10 08:00:00,u1,Always On\n"
              "2024-01-15 09:30:00,u2,None\n2024-01-15 23:59:00,u3,\n"),
        write(tmp_path / "web_traffic_late.csv",
              "event_datetime,user_id,campaign\n2024-01-15 09:30:00,u2,None\n2024-01-20 10:00:00,u4,BTS 2024\n"),
    ]
    return files


def test_profile_inventory_drift_and_overlap(spark, tmp_path):
    rep = profile_files(spark, fixtures(tmp_path))
    inv = {r.file: r for r in rep["inventory"].collect()}
    assert inv["paid_instagram_part3.csv"].n_columns == 8 and inv["paid_tiktok_part2.csv"].n_columns == 6
    r = inv["paid_instagram_part1.csv"]
    assert (r.stream, r.stream_group, r.format, r.n_rows, r.total_nulls, r.date_columns) == ("paid_instagram", "paid_social", ".csv", 2, 0, "date")
    assert r.path.endswith("/paid_instagram_part1.csv") and r.size_bytes > 100 and r.columns.startswith("date; channel; ")
    r = inv["web_traffic_early.csv"]
    assert (r.stream, r.stream_group, r.distinct_dates, r.total_nulls) == ("web_traffic", "web_analytics", 2, 2)
    assert inv["web_traffic_early.csv"].granularity == "event-level"
    assert inv["paid_instagram_part1.csv"].granularity == "daily"
    assert inv["web_traffic_early.csv"].missing_date_count == 4
    drift = {(r.stream, r.column_name): r for r in rep["drift"].collect()}
    # files are compared inside one datastream: single files of a platform have none to compare with
    assert drift[("paid_instagram", "spend_usd")].present_in == "paid_instagram_part3.csv"
    assert drift[("paid_instagram", "date")].status == "common"
    assert drift[("web_traffic", "campaign")].status == "common"
    assert {k for k, _ in drift} == {"paid_instagram", "web_traffic"}
    ov = rep["overlap"].collect()
    assert len(ov) == 1 and ov[0].stream == "web_traffic"
    # the overlap window is compared as dates, so the 23:59 event on the last day counts
    assert (str(ov[0].overlap_start), str(ov[0].overlap_end), ov[0].rows_a, ov[0].rows_b) == \
        ("2024-01-15", "2024-01-15", 2, 1)
    assert not [r for r in ov if r.stream.startswith("paid_")]


def test_drift_union_from_files_equals_standard(spark, tmp_path):
    files = [f for f in fixtures(tmp_path) if "paid_" in f]
    tagged, headers = read_tagged(spark, files)
    rules = (("instagram_part3", "rename", "spend_usd", "spend"), ("instagram_part3", "drop", "spend_currency", None),
             ("pinterest_part1", "rename", "link_clicks", "clicks"), ("tiktok_part2", "rename", "views", "video_views"))
    target = T.StructType([T.StructField("date", T.DateType()), T.StructField("channel", T.StringType()),
                           T.StructField("spend", T.DecimalType(18, 2)), T.StructField("clicks", T.LongType()),
                           T.StructField("video_views", T.LongType()), T.StructField("optimization_goal", T.StringType())])
    out = sorted(resolve_drift_tagged(tagged, "_source_file", rules, target).collect())
    assert [(str(r.date), r.channel, float(r.spend), r.clicks, r.video_views, r.optimization_goal) for r in out] == [
        ("2024-01-01", "Instagram", 10.5, 3, 7, "awareness"), ("2024-01-02", "Instagram", 11.0, 4, 8, "awareness"),
        ("2024-01-03", "Pinterest", 4.0, 2, 1, "traffic"), ("2024-01-04", "TikTok", 6.75, 1, 30, None),
        ("2024-01-05", "Instagram", 12.25, 5, 9, "awareness")]
    assert headers["paid_tiktok_part2.csv"] == ("date", "channel", "campaign_id", "spend", "clicks", "views")
