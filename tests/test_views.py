"""Invariants of the domain views over the driver tables."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martline.sources import views

pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF_SMALL}/lineitem.parquet"), reason="no driver tables")


def test_txn_keeps_every_line_item(spark):
    assert views.v_txn(spark, SF_SMALL).count() == views.table(spark, SF_SMALL, "lineitem").count()


def test_web_extracts_overlap_only_inside_the_window(spark):
    parts = views.v_web_parts(spark, SF_SMALL)
    per_event = parts.groupBy("event_datetime", "user_id", "page_url").agg(
        F.count(F.lit(1)).alias("copies"), F.min("event_datetime").alias("ts"))
    inside = (F.col("ts") >= F.lit(views.WEB_B_START).cast("timestamp_ntz")) & \
             (F.col("ts") < F.lit(views.WEB_A_END).cast("timestamp_ntz"))
    bad = per_event.where((inside & (F.col("copies") < 2)) | (~inside & (F.col("copies") != 1))).count()
    assert bad == 0
    assert parts.select("event_datetime", "user_id", "page_url").distinct().count() == \
        views.v_web(spark, SF_SMALL).select("event_datetime", "user_id", "page_url").distinct().count()


def test_paid_extracts_carry_only_their_own_columns(spark):
    raw = views.paid_raw(spark, SF_SMALL)
    cols = views.paid_file_columns()
    for f in ("instagram_part3", "pinterest_part1", "tiktok_part2", "instagram_part1"):
        part = raw.where(F.col("_file") == f)
        if part.limit(1).count() == 0:
            continue
        filled = part.agg(*[F.count(F.col(c)).alias(c) for c in raw.columns if c != "_file"]).collect()[0].asDict()
        for c, n in filled.items():
            assert (n > 0) == (c in cols[f]), (f, c)


def test_airport_lookup_restricted_to_active_suppliers(spark):
    from martline.plans import warehouse as wh
    lk = wh.airport_lookup(spark, SF_SMALL)
    active = views.table(spark, SF_SMALL, "supplier").where("s_acctbal >= 0").count()
    assert lk.count() == active
    assert lk.where(F.col("state").contains("-")).count() == 0
