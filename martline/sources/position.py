"""Row positions: the order of rows in their files, as columns.

A DataFrame has no order, so "first" needs one.  Readers here add ``file`` (the
file's name) and ``row`` (from 0, the row's place in it): Parquet keeps a row
index; a CSV file is read in splits, whose rows come in order, so a row's
place is its place in the split plus the row counts of the splits before it
(a table of one row per split).  Everything that asks for a first row then
orders by these columns, whatever shuffles lie between.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martline.operators.quantiles import surrogate_key

FILE, ROW = "file", "row"


def read_parquet_rows(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parquet files with ``file`` and ``row``."""
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    return df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))


def read_csv_rows(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """CSV files with a header as strings, with ``file`` and ``row`` (no line breaks inside fields)."""
    reader = spark.read.option("header", True)
    for name, value in options.items():
        reader = reader.option(name, value)
    df = reader.csv([paths] if isinstance(paths, str) else list(paths))
    placed = df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"))
    splits = placed.groupBy(F.col(FILE).alias("_file"), F.col("_start").alias("_at")).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_file").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    joined = placed.join(splits, (F.col(FILE) == F.col("_file")) & (F.col("_start") == F.col("_at")))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], FILE, (F.col("_before") + F.col("_id") - F.col("_first")).alias(ROW))


def first_rows(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str] = (FILE, ROW)) -> DataFrame:
    """The values of each key's first row (nulls included; null keys are a key)."""
    first = F.min_by(F.struct(*values), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*keys, *[F.col(f"_first.{v}").alias(v) for v in values])


def first_values(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str] = (FILE, ROW)) -> DataFrame:
    """A3 as pandas ``groupby().first()``: for each value column the first that is not null."""
    place = F.struct(*order)
    return df.groupBy(*keys).agg(*[F.min_by(v, F.when(F.col(v).isNotNull(), place)).alias(v) for v in values])


def number_by_appearance(df: DataFrame, keys: Sequence[str], out: str = "key", rows_per_bucket: int = 1 << 16, order: Sequence[str] = (FILE, ROW)) -> DataFrame:
    """The distinct keys numbered from 1 in order of first appearance, in parallel over stretches of a file's rows."""
    first = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_at"))
    placed = first.select(*keys, *[F.col(f"_at.{o}").alias(f"_o{i}") for i, o in enumerate(order)])
    names = [f"_o{i}" for i in range(len(order))]
    buckets = [*map(F.col, names[:-1]), F.floor(F.col(names[-1]) / rows_per_bucket)]
    return surrogate_key(placed, names, out, buckets, few_first=True).select(*keys, out)
