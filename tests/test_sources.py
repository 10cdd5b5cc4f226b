"""Readers, sinks and lookups on small files written to a scratch folder."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.sources import files, sinks


def test_csv_reader_null_tokens_header_and_zip(spark, tmp_path):
    p = tmp_path / "web_part1.csv"
    p.write_text(" Date ,Campaign,Zip_Code\n2024-01-01,None,03101\n2024-01-02,,30301\n2024-01-03,Always On,00501\n")
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("campaign", T.StringType()),
                           T.StructField("zip_code", T.StringType())])
    df = files.read_source(spark, str(p), schema)
    rows = sorted(df.collect())
    assert df.columns == ["date", "campaign", "zip_code", "_source_file"]
    assert [r.campaign for r in rows] == [None, None, "Always On"]
    assert [r.zip_code for r in rows] == ["03101", "30301", "00501"]
    assert rows[0]._source_file == "web_part1.csv"


def test_untyped_reader_keeps_empty_strings(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text("A,B\nx,\n,None\n")
    rows = sorted(files.read_untyped(spark, str(p)).collect(), key=lambda r: r.a)
    assert [(r.a, r.b) for r in rows] == [("", "None"), ("x", "")]


def test_airport_lookup(spark):
    raw = spark.createDataFrame([(" ATL ", "Hartsfield", "Atlanta", "US-GA", "US"),
                                 ("LAX", "LA Intl", "Los Angeles", "US-CA", "US"),
                                 ("XYZ", "Other", "Nowhere", "GA", "US")],
                                "iata_code string, name string, municipality string, iso_region string, iso_country string")
    codes = spark.createDataFrame([("ATL",), ("XYZ",)], "code string")
    got = {r.iata_code: r.state for r in files.airport_lookup(raw, codes).collect()}
    assert got == {"ATL": "GA", "XYZ": "GA"}


def test_write_outputs_and_observe(spark, tmp_path):
    clean = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0), (dt.date(2024, 2, 1), 2.0)], "date date, v double")
    clean, obs = sinks.observe_step(clean, "step", "date")
    paths = sinks.write_outputs(clean, "detail", {"total": lambda d: d.agg(F.sum("v").alias("v"))}, str(tmp_path))
    assert spark.read.parquet(paths["total"]).collect()[0].v == 3.0 and spark.read.parquet(paths["detail"]).count() == 2
    assert obs.get["rows"] == 2
    sinks.write_table(clean, str(tmp_path / "by_month"), by_month="date")
    assert sorted(p for p in os.listdir(tmp_path / "by_month") if "=" in p) == ["part_month=2024-01", "part_month=2024-02"]
    kept = sinks.read_table(spark, str(tmp_path / "by_month"), "date", "2024-01-15", "2024-02-15")
    assert kept.columns == ["date", "v"] and [r.v for r in kept.collect()] == [2.0]


def test_publish_and_sorted_export(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame([(2, "b"), (None, "c"), (1, "a")], "k int, v string").write.parquet(src)
    sinks.publish(spark, [(src, str(tmp_path / "dest"))])
    assert spark.read.parquet(str(tmp_path / "dest")).count() == 3
    sinks.export_sorted(spark.read.parquet(src), str(tmp_path / "csv"), ["k"])
    lines = []
    for f in sorted(os.listdir(tmp_path / "csv")):
        if f.endswith(".csv"):
            lines += (tmp_path / "csv" / f).read_text().splitlines()[1:]
    assert [ln.split(",")[0] for ln in lines] == ["1", "2", '""'] or [ln.split(",")[0] for ln in lines] == ["1", "2", ""]


def test_schema_columns_matched_by_name_not_position(spark, tmp_path):
    a = tmp_path / "part1.csv"
    b = tmp_path / "part2.csv"
    a.write_text("Date,Spend,Clicks\n2024-01-01,1.50,3\n")
    b.write_text("clicks,date,extra,spend\n4,2024-01-02,x,2.25\n")
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("spend", T.DoubleType()),
                           T.StructField("clicks", T.LongType()), T.StructField("goal", T.StringType())])
    rows = sorted(files.read_source(spark, [str(a), str(b)], schema).collect())
    assert [(str(r.date), r.spend, r.clicks, r.goal, r._source_file) for r in rows] == [
        ("2024-01-01", 1.5, 3, None, "part1.csv"), ("2024-01-02", 2.25, 4, None, "part2.csv")]


def _swapped(folder):
    folder.mkdir(exist_ok=True)
    (folder / "p1.csv").write_text("a,b\n1,x\n")
    (folder / "p2.csv").write_text("b,a,c\ny,2,z\n")
    return folder


def test_folders_globs_and_lists_are_matched_by_name(spark, tmp_path):
    folder = _swapped(tmp_path / "in")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    for paths in (str(folder), str(folder / "*.csv"), [str(folder / "p1.csv"), str(folder / "p2.csv")]):
        typed = files.read_source(spark, paths, schema)
        assert sorted((r.a, r.b, r._source_file) for r in typed.collect()) == [(1, "x", "p1.csv"), (2, "y", "p2.csv")]
        plain = files.read_source(spark, paths)
        assert sorted((r.a, r.b, r.c, r._source_file) for r in plain.collect()) == [("1", "x", None, "p1.csv"), ("2", "y", "z", "p2.csv")]


def test_equal_names_in_two_folders_stay_apart(spark, tmp_path):
    one, two = _swapped(tmp_path / "one"), tmp_path / "two"
    two.mkdir()
    (two / "p1.csv").write_text("d,a\nq,3\n")
    df, headers = files.read_tagged(spark, [str(one), str(two)])
    assert sorted(len(h) for h in headers.values()) == [2, 2, 3] and len(headers) == 3
    rows = {r._source_file.rsplit("/", 2)[-2:][0] if "/" in r._source_file else r._source_file: r for r in df.collect()}
    assert rows["one"].a == "1" and rows["two"].a == "3" and rows["two"].d == "q" and rows["one"].d is None and rows["p2.csv"].c == "z"
    assert set(headers) == {r._source_file for r in rows.values()}


def test_quoted_header_and_empty_file(spark, tmp_path):
    (tmp_path / "q.csv").write_text('"A, B",c\n1,2\n')
    (tmp_path / "empty.csv").write_text("")
    df = files.read_source(spark, str(tmp_path))
    assert df.columns == ["a, b", "c", "_source_file"] and df.count() == 1
