"""Jobs over files that are written from the given tables and read again.

Each writes under the shared checkpoint folder and returns what a reader finds there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.session import ensure_checkpoint_dir
from martline.sources import files, infer, position, sinks, versions


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV; timestamps as text, so that no digits are lost."""
    plain = [F.col(f"`{c}`").cast("string").alias(c) if t.startswith("timestamp") else F.col(f"`{c}`") for c, t in df.dtypes]
    df.select(*plain).write.option("header", True).csv(path)


def csv_types(df: DataFrame) -> DataFrame:
    """(column_name, type, n_values) as inferred from the table written as CSV, in two folders whose headers differ in order."""
    spark = df.sparkSession
    base = scratch(spark, "csv")
    half = F.crc32(F.col(f"`{df.columns[0]}`").cast("string").cast("binary")) % 2 == 0
    write_csv(df.where(half), f"{base}/a")
    write_csv(df.where(~half).select(*reversed(df.columns)), f"{base}/b")
    raw = files.read_source(spark, f"{base}/*/*.csv")
    found = infer.with_types(infer.merge(infer.evidence(raw, "_source_file")))
    return found.select("column_name", "type", "n_values")


def csv_round_trip(df: DataFrame) -> DataFrame:
    """The table written as CSV and read back with inferred types."""
    base = scratch(df.sparkSession, "csv")
    write_csv(df, f"{base}/a")
    return infer.read_inferred(df.sparkSession, f"{base}/*/*.csv").drop("_source_file")


def csv_untyped(df: DataFrame) -> DataFrame:
    """Per column of the table written as CSV, rows, empty fields and distinct texts as an untyped reader sees them."""
    base = scratch(df.sparkSession, "csv")
    write_csv(df, base)
    text = files.read_untyped(df.sparkSession, base, source_col="")
    named = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("v")) for c in text.columns])
    return (text.select(F.inline(named)).groupBy("column_name")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("v") == "").alias("empty"), F.count_distinct("v").alias("distinct_texts")))


def month_slice(df: DataFrame, date: str, start: str, end: str) -> DataFrame:
    """K1: rows per day between two dates, read from the table written in month folders."""
    path = scratch(df.sparkSession, "by-month")
    sinks.write_table(df, path, by_month=date)
    return sinks.read_table(df.sparkSession, path, date, start, end).groupBy(date).agg(F.count(F.lit(1)).alias("n_rows"))


def two_outputs(clean: DataFrame, outputs: dict, row_by_row: tuple[str, ...] = ()) -> DataFrame:
    """K2: (table_name, n_rows) of the tables written from one cleaned frame."""
    spark = clean.sparkSession
    paths = sinks.write_outputs(clean, "clean", outputs, scratch(spark, "outputs"), by_month="date", row_by_row=row_by_row)
    out = None
    for name, path in sorted(paths.items()):
        n = sinks.read_table(spark, path).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = n if out is None else out.unionByName(n)
    return out


def replaced_table(first: DataFrame, second: DataFrame) -> DataFrame:
    """K1: (version, n_rows, current, verified) of a table written twice, as its log and its data say."""
    spark = first.sparkSession
    path = scratch(spark, "versioned")
    for df in (first, second):
        last = versions.replace(df, path)
    out = None
    for version, _ in versions.versions(spark, path):
        kept = versions.read_version(spark, path, version)
        n = kept.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(version).cast("bigint").alias("version"), "n_rows", F.lit(version == last).alias("current"),
                                                              F.lit(versions.verify(spark, path)).alias("verified"))
        out = n if out is None else out.unionByName(n)
    return out


def published(tables: dict[str, DataFrame], changed: dict[str, DataFrame]) -> DataFrame:
    """K3: (table_name, n_rows, verified, change_found): copies compared with their source, and with tables that differ from it."""
    spark = next(iter(tables.values())).sparkSession
    base = scratch(spark, "published")
    rows = []
    for name, df in sorted(tables.items()):
        df.write.parquet(f"{base}/source/{name}")
    sinks.publish(spark, [(f"{base}/source/{n}", f"{base}/copy/{n}") for n in sorted(tables)])
    for name in sorted(tables):
        copy = versions.checksum(spark.read.parquet(f"{base}/copy/{name}"))
        source = versions.checksum(spark.read.parquet(f"{base}/source/{name}"))
        rows.append((name, copy.rows, copy == source, versions.checksum(changed[name]) != source))
    return spark.createDataFrame(rows, "table_name string, n_rows bigint, verified boolean, change_found boolean")


def exported_order(df: DataFrame, sort_cols: list[str], descending: list[str], keep: list[str]) -> DataFrame:
    """O1/O2: ``keep`` and the row's place (from 1) in the sorted CSV export, over its files in name order."""
    spark = df.sparkSession
    path = scratch(spark, "export")
    sinks.export_sorted(df, path, sort_cols, descending)
    read = position.read_csv_rows(spark, path)
    return position.number_by_appearance(read, [*keep], "place")
