"""The full rebuild writes every layer and reads the next layer from storage."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF_SMALL}/lineitem.parquet"), reason="no driver tables")


def test_rebuild_matches_direct_queries(spark, tmp_path):
    import __spark_entry__ as entry
    from martline.plans.rebuild import rebuild
    from martline.sources.sinks import read_table
    out = str(tmp_path / "wh")
    paths = rebuild(spark, SF_SMALL, out, strict=True, publish_dir=str(tmp_path / "published"))  # raises if any quality check fails
    q = entry.queries()

    def same(table, query):
        a = read_table(spark, paths[table])
        b = q[query](spark, SF_SMALL)
        a = a.select(*sorted(a.columns))
        b = b.select(*sorted(b.columns))
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, table

    same("fact_ecommerce_daily", "ecommerce_daily")
    same("fact_web_analytics_daily", "web_daily")
    same("fact_ooh_daily", "ooh_daily")
    same("dim_geography", "geography_dim")
    same("cross_channel_daily", "cross_channel_daily")
    same("lag_correlations_resid", "lag_corr_resid")
    same("promo_impact_summary", "promo_impact")
    # facts are laid out by month for partition pruning
    for fact in ("fact_paid_social_daily", "fact_ecommerce_daily", "fact_ecommerce_transactions"):
        assert any(p.startswith("part_month=") for p in os.listdir(paths[fact]))
    steps = {r.step: r.rows for r in spark.read.parquet(paths["step_metrics"]).collect()}
    assert steps["fact_ooh_daily"] == spark.read.parquet(paths["fact_ooh_daily"]).count()
    published = str(tmp_path / "published")
    assert sorted(os.listdir(published)) == sorted(n for n in paths if n.startswith(("fact_", "dim_")))
    assert spark.read.parquet(f"{published}/fact_ecommerce_daily").count() == q["ecommerce_daily"](spark, SF_SMALL).count()
    summary = {r.status: r.checks for r in spark.read.parquet(paths["quality_summary"]).collect()}
    assert summary.get("FAIL", 0) == 0 and summary["TOTAL"] > 20


def test_month_partitions_are_pruned(spark, tmp_path):
    from martline.plans import warehouse as wh
    from martline.sources.sinks import read_table, write_table
    path = str(tmp_path / "fact_ecommerce_daily")
    write_table(wh.ecommerce_daily(spark, SF_SMALL), path, by_month="date")
    df = read_table(spark, path, "date", "1998-01-01", "1998-01-31")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_month" in plan and "part_month" not in df.columns
    # a month is one file here, not one per task
    assert all(len([f for f in os.listdir(os.path.join(path, p)) if f.endswith(".parquet")]) == 1
               for p in os.listdir(path) if p.startswith("part_month="))
    assert df.count() == wh.ecommerce_daily(spark, SF_SMALL).where(
        F.year("date") == 1998).where(F.month("date") == 1).count()


def test_csv_export_is_sorted(spark, tmp_path):
    from martline.plans import warehouse as wh
    from martline.plans.rebuild import export_csv
    from martline.sources.sinks import write_table
    p = str(tmp_path / "fact_organic_social_daily")
    write_table(wh.organic_daily(spark, SF_SMALL), p, by_month="date")
    out = export_csv(spark, {"fact_organic_social_daily": p}, str(tmp_path / "csv"))
    df = spark.read.option("header", True).csv(out["fact_organic_social_daily"])
    assert "part_month" not in df.columns and df.count() == wh.organic_daily(spark, SF_SMALL).count()
    files = sorted(f for f in os.listdir(out["fact_organic_social_daily"]) if f.endswith(".csv"))
    dates = []
    for f in files:
        with open(os.path.join(out["fact_organic_social_daily"], f)) as fh:
            dates += [ln.split(",")[0] for ln in fh.read().splitlines()[1:]]
    assert dates == sorted(dates)


def test_rebuild_from_raw_csv_equals_rebuild_from_tables(spark, tmp_path):
    """The streams written as raw CSV extracts (drifted headers, overlapping web files) and built from there."""
    from martline.plans import warehouse as wh
    from martline.plans.rebuild import rebuild, rebuild_from_csv
    from martline.sources import views
    from martline.sources.sinks import read_table
    folder = tmp_path / "raw"
    folder.mkdir()

    def land(df, name):
        # the CSV writer cuts timestamps to milliseconds, a string keeps all digits
        df = df.select(*[F.col(c).cast("string").alias(c) if t.startswith("timestamp") else F.col(c) for c, t in df.dtypes])
        df.coalesce(1).write.option("header", True).csv(str(tmp_path / "csv" / name))
        part = next(f for f in os.listdir(tmp_path / "csv" / name) if f.endswith(".csv"))
        os.link(tmp_path / "csv" / name / part, folder / f"{name}.csv")

    for name, df in views.paid_parts(spark, SF_SMALL).items():
        land(df, f"paid_{name}")
    web = views.v_web_parts(spark, SF_SMALL)
    for tag in ("web_a", "web_b"):
        land(web.where(F.col("_source") == tag).drop("_source", "date"), f"web_traffic_{tag}")
    land(views.v_txn(spark, SF_SMALL).drop("date"), "transactions")
    land(views.v_posts(spark, SF_SMALL), "tiktok_owned")
    land(views.v_mentions(spark, SF_SMALL), "podcast_mentions")
    land(views.v_ooh_weekly(spark, SF_SMALL), "ooh_airport_weekly")
    start, end = wh.WEB_OVERLAP
    built = rebuild_from_csv(spark, str(folder), wh.airport_lookup(spark, SF_SMALL), ("web_traffic_web_b.csv", start, end), str(tmp_path / "a"), strict=True)
    want = rebuild(spark, SF_SMALL, str(tmp_path / "b"))
    for name in want:
        if name.startswith(("fact_", "dim_", "cross_")):
            a, b = (read_table(spark, p[name]) for p in (built, want))
            b = b.select(*a.columns)
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
