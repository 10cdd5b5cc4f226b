"""Profiling jobs (R1-R10): per-column profiles, granularity, drift and overlap reports.

All of them are aggregates over the data (one scan per input, columns
unpivoted so there is one job per table rather than one per column); file
schemas are driver metadata.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.operators.joins import interval_pairs

NUMERIC = {"int", "bigint", "double", "float", "smallint", "tinyint"}

# Stream classification (R7).  A file belongs to the first
# datastream whose key its name contains, and with it to a stream group.
STREAM_KEYS = (
    ("paid_instagram", "paid_social"),
    ("paid_pinterest", "paid_social"),
    ("paid_tiktok", "paid_social"),
    ("web_traffic", "web_analytics"),
    ("transactions", "ecommerce"),
    ("tiktok_owned", "organic_social"),
    ("podcast_mentions", "podcast"),
    ("ooh_airport", "ooh"),
)


def classify_stream(name_col, keys=STREAM_KEYS):
    """The datastream (first key contained in the lower-cased file name), else 'unknown'."""
    low = F.lower(name_col if not isinstance(name_col, str) else F.col(name_col))
    expr = None
    for key, _ in keys:
        expr = F.when(low.contains(key), key) if expr is None else expr.when(low.contains(key), key)
    return expr.otherwise("unknown")


def stream_group(stream_col, keys=STREAM_KEYS):
    """The group a datastream belongs to, else 'unknown'."""
    col = F.col(stream_col) if isinstance(stream_col, str) else stream_col
    expr = None
    for key, group in keys:
        expr = F.when(col == key, group) if expr is None else expr.when(col == key, group)
    return expr.otherwise("unknown")


def drift_report(parts: Mapping[str, DataFrame], stream_of: Callable[[str], str]) -> DataFrame:
    """Per stream with at least two files, each column's presence across files.

    Per file, one count aggregate (read from the data) is tagged with the
    file's column list (schema metadata); the report is a ``groupBy(stream,
    column)`` whose file lists are bounded by the number of files.
    """
    rows = None
    for f, df in sorted(parts.items()):
        r = df.agg(F.count(F.lit(1)).alias("file_rows")).select(
            F.lit(stream_of(f)).alias("stream"), F.lit(f).alias("file"), "file_rows",
            F.explode(F.array(*[F.lit(c) for c in df.columns])).alias("column_name"))
        rows = r if rows is None else rows.unionByName(r)
    return _drift_from_rows(rows)


def drift_report_tagged(df: DataFrame, source_col: str, columns_by_source: Mapping[str, Sequence[str]],
                        stream_of: Callable[[str], str]) -> DataFrame:
    """R8 for extracts read in one tagged scan: row counts come from one
    ``groupBy(source)``; each extract's header comes from schema metadata."""
    counts = df.groupBy(F.col(source_col).alias("file")).agg(F.count(F.lit(1)).alias("file_rows"))
    meta = [(f, stream_of(f), c) for f, cols in sorted(columns_by_source.items()) for c in cols]
    meta_df = df.sparkSession.createDataFrame(meta, "file string, stream string, column_name string")
    rows = meta_df.join(counts, "file", "left").na.fill(0, subset=["file_rows"])
    return _drift_from_rows(rows)


def _drift_from_rows(rows: DataFrame) -> DataFrame:
    per_stream = rows.groupBy("stream").agg(F.count_distinct("file").alias("n_files"),
                                            F.array_sort(F.collect_set("file")).alias("_all"))
    cols = rows.groupBy("stream", "column_name").agg(F.array_sort(F.collect_set("file")).alias("_present"),
                                                     F.sum("file_rows").alias("rows_present"))
    out = cols.join(per_stream, "stream").where(F.col("n_files") >= 2)
    absent = F.array_except("_all", "_present")
    return out.select(
        "stream", "column_name",
        F.concat_ws(",", "_present").alias("present_in"),
        F.concat_ws(",", absent).alias("absent_from"),
        F.when(F.size(absent) == 0, "common").otherwise("differing").alias("status"),
        "rows_present")


def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 2,
                    exact_median: bool = True) -> DataFrame:
    """Min, max, mean, median (mean/median/stdev rounded), sample stdev per numeric column.

    Columns are unpivoted into ``(column_name, value)`` so one grouped
    aggregate profiles them all.  ``exact_median`` uses ``median`` (a
    value->count map per column, merged map-side); ``False`` uses
    ``percentile_approx`` for unbounded-cardinality columns.
    """
    cols = list(cols or [c for c, t in df.dtypes if t in NUMERIC or t.startswith("decimal")])
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                  F.col(c).cast("double").alias("v")) for c in cols])).alias("_u")
                     ).select("_u.column_name", "_u.v")
    stats = long.groupBy("column_name").agg(
        F.count("v").alias("non_null"),
        F.min("v").alias("min"), F.max("v").alias("max"),
        F.round(F.avg("v"), digits).alias("mean"),
        F.round(F.stddev_samp("v"), digits).alias("stdev"))
    if exact_median:
        from martline.operators.quantiles import exact_median as _em
        med = _em(long, ["column_name"], "v", "_med")
        out = stats.join(med, "column_name", "left")
    else:
        out = stats.join(long.groupBy("column_name").agg(F.percentile_approx("v", 0.5, 10000).alias("_med")),
                         "column_name", "left")
    return out.select("column_name", "non_null", "min", "max", "mean", F.round("_med", digits).alias("median"),
                      "stdev")


def column_profile(df: DataFrame, digits: int = 2, exact: bool = True) -> DataFrame:
    """Per column role, null count and percent, distinct count.

    Every column is cast to string and unpivoted into ``(column_name,
    value)``; one grouped aggregate gives counts for all columns (the
    distinct count shuffles by (column, value), so a hot column is spread by
    its values).  ``exact=False`` instead computes one ``approx_count_distinct``
    (HyperLogLog, ~1% error) per column in a single pass with no value shuffle,
    for very wide or very large tables.  Roles follow the column type
    (date/timestamp -> date, numeric -> numeric, else categorical).
    """
    roles = {}
    for c, t in df.dtypes:
        roles[c] = "date" if t in ("date", "timestamp", "timestamp_ntz") else (
            "numeric" if t in NUMERIC or t.startswith("decimal") else "categorical")
    if not exact:
        aggs = []
        for c in df.columns:
            aggs += [F.count_if(F.col(c).isNull()).alias(c + "__nulls"),
                     F.approx_count_distinct(F.col(c)).alias(c + "__nd")]
        wide = df.agg(F.count(F.lit(1)).alias("_rows"), *aggs)
        arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(roles[c]).alias("role"),
                                 F.col(c + "__nulls").alias("nulls"), F.col(c + "__nd").alias("n_unique"))
                        for c in df.columns])
        long = wide.select("_rows", F.explode(arr).alias("_u")).select("_rows", "_u.*")
        return long.select("column_name", "role", F.col("_rows").alias("rows"), "nulls",
                           F.round(F.col("nulls") * 100.0 / F.col("_rows"), digits).alias("null_pct"), "n_unique")
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                  F.col(c).cast("string").alias("v")) for c in df.columns])
                               ).alias("_u")).select("_u.column_name", "_u.v")
    role_col = None
    for c, r in roles.items():
        role_col = (F.when(F.col("column_name") == c, r) if role_col is None
                    else role_col.when(F.col("column_name") == c, r))
    agg = long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("v").isNull()).alias("nulls"),
        F.count_distinct("v").alias("n_unique"))
    return agg.select("column_name", role_col.alias("role"), "rows", "nulls",
                      F.round(F.col("nulls") * 100.0 / F.col("rows"), digits).alias("null_pct"), "n_unique")


def top_values(df: DataFrame, cols: Sequence[str], k: int = 5) -> DataFrame:
    """The k most frequent values per categorical column (ties by value)."""
    from martline.operators.topk import top_k
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                  F.col(c).cast("string").alias("value")) for c in cols])
                               ).alias("_u")).select("_u.column_name", "_u.value").where(F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return top_k(counts, ["column_name"], [F.col("n").desc(), F.col("value").asc()], k, salt_on=["value"],
                 rank_col="value_rank")


def date_profile(df: DataFrame, date_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Min, max, distinct days and missing days inside [min, max]."""
    d = F.to_date(F.col(date_col))
    g = df.select(*by, d.alias("_d")).groupBy(*by).agg(
        F.min("_d").alias("min_date"), F.max("_d").alias("max_date"), F.count_distinct("_d").alias("distinct_days"))
    return g.withColumn("missing_days", F.datediff("max_date", "min_date") + 1 - F.col("distinct_days"))


def granularity(df: DataFrame, ts_col: str, by: Sequence[str] = ()) -> DataFrame:
    """R2: event-level when any timestamp has a non-midnight hour or minute;
    else the median gap between successive distinct dates decides
    (<=1 daily, 5-9 weekly, 25-35 monthly, otherwise '~N-day' with N
    truncated; 'unknown' when there is no gap to measure)."""
    from martline.operators.windows import day_gaps
    ts = F.col(ts_col)
    has_time = df.groupBy(*by).agg(F.max(((F.hour(ts) != 0) | (F.minute(ts) != 0)).cast("int")).alias("_t"))
    gaps = day_gaps(df.select(*by, F.to_date(ts).alias("_d")), "_d", by)
    # one gap per distinct date: bounded by the calendar, so an exact median is cheap
    med = gaps.groupBy(*by).agg(F.median("gap").alias("median_gap"))
    if by:
        j = has_time.join(med, list(by), "left")
    else:
        j = has_time.withColumn("_one", F.lit(1)).join(med.withColumn("_one", F.lit(1)), "_one", "left").drop("_one")
    return j.select(*by, F.col("median_gap"), granularity_label(F.col("_t") == 1, F.col("median_gap")).alias("granularity"))


def granularity_label(timed: Column, gap: Column) -> Column:
    """R2's rule from whether any moment has a time of day and the median gap in days."""
    return (F.when(timed, "event-level").when(gap.isNull(), "unknown").when(gap <= 1, "daily").when((gap >= 5) & (gap <= 9), "weekly")
            .when((gap >= 25) & (gap <= 35), "monthly").otherwise(F.concat(F.lit("~"), F.floor(gap).cast("bigint").cast("string"), F.lit("-day"))))


def overlap_report(df: DataFrame, file_col: str, date_col: str, within: Sequence[str] = ()) -> DataFrame:
    """Pairs of files whose date ranges overlap, with each file's rows in
    the overlap window (compared as dates, so late events on the last day count).

    Everything after the count per file and day works on that small table.
    ``within`` names columns (a stream) inside which files are compared.
    """
    by = [F.col(c) for c in within]
    daily = (df.groupBy(*by, F.col(file_col).alias("_f"), F.to_date(F.col(date_col)).alias("_d"))
             .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_d").isNotNull()))
    ranges = daily.groupBy(*by, "_f").agg(F.min("_d").alias("_s"), F.max("_d").alias("_e"))
    pairs = interval_pairs(ranges, "_f", "_s", "_e", within)
    each = pairs.select("*", F.explode(F.array(F.struct(F.lit(True).alias("is_a"), F.col("file_a").alias("_f")),
                                               F.struct(F.lit(False).alias("is_a"), F.col("file_b").alias("_f")))).alias("_x"))
    each = each.select(*pairs.columns, "_x.is_a", "_x._f")
    rows = each.join(daily, [*within, "_f"]).where(F.col("_d").between(F.col("overlap_start"), F.col("overlap_end")))
    n = lambda a: F.coalesce(F.sum(F.when(F.col("is_a") == a, F.col("_n"))), F.lit(0)).cast("bigint")
    found = rows.groupBy(*pairs.columns).agg(n(True).alias("rows_a"), n(False).alias("rows_b"))
    # a window may hold no row of either file
    return pairs.join(found, pairs.columns, "left").na.fill(0, subset=["rows_a", "rows_b"])


# The date / datetime layouts a string column may use to count
# as a date column (a bare number is not a date).
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd",
                "MM/dd/yyyy")


def layout_marks(fmt: str) -> list[str]:
    """The punctuation that every text of a layout holds; none is known of layouts with optional parts or padding."""
    plain = re.sub(r"'[^']*'", "", fmt)
    return [] if re.search(r"[\[\]'p]", plain) else sorted(set(re.findall(r"[-/:., ]", plain)))


def parse_any(v, formats=DATE_FORMATS):
    """first successful parse among explicit layouts, NULL when none fits.

    A text without a layout's punctuation can't fit it and is not parsed: a
    failed parse costs far more than a look for a character.
    """
    def tried(f):
        there = [v.cast("string").contains(F.lit(m)) for m in layout_marks(f)]
        ts = F.try_to_timestamp(v, F.lit(f))
        return F.when(functools.reduce(Column.__and__, there), ts) if there else ts
    return F.coalesce(*[tried(f) for f in formats])


def detect_date_columns(df: DataFrame, cols: Sequence[str] | None = None, formats=DATE_FORMATS) -> DataFrame:
    """String columns all of whose non-null values parse as dates/timestamps.

    One aggregate over the whole table for all columns, so a single value
    that is no date decides wherever it stands; a column without values is
    not a date column.
    """
    cols = list(cols or [c for c, t in df.dtypes if t == "string"])
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, non_null bigint, is_date boolean")
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c)
        aggs += [F.count(v).alias(f"n{i}"), F.count_if(v.isNotNull() & parse_any(v, formats).isNull()).alias(f"bad{i}")]
    found = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("non_null"),
                               ((F.col(f"n{i}") > 0) & (F.col(f"bad{i}") == 0)).alias("is_date")) for i, c in enumerate(cols)])
    return df.agg(*aggs).select(F.explode(found).alias("_u")).select("_u.*")


class Extracts(NamedTuple):
    """Extracts read as one frame: the column that names the file, and each file's header and date columns (the first decides)."""

    df: DataFrame
    file: Column
    headers: Mapping[str, Sequence[str]]
    dates: Mapping[str, Sequence[str]]


def inventory(spark, sources: Sequence[Extracts]) -> DataFrame:
    """Per extract its size, columns, nulls, dates, granularity and stream.

    Every source is read once: rows become (file, null count, moment) and are
    grouped by file and day; all figures follow from that small table.
    """
    rows, meta = None, []
    for source in sources:
        nulls = moment = None
        for name in sorted(source.headers):
            own, dates = source.headers[name], source.dates.get(name, ())
            n = sum((F.col(f"`{c}`").isNull().cast("int") for c in own), F.lit(0))
            ts = F.col(f"`{dates[0]}`").cast("timestamp_ntz") if dates else F.lit(None).cast("timestamp_ntz")
            this = source.file == name
            nulls = F.when(this, n) if nulls is None else nulls.when(this, n)
            moment = F.when(this, ts) if moment is None else moment.when(this, ts)
            meta.append((name, len(own), "; ".join(own), "; ".join(dates)))
        part = source.df.select(source.file.alias("filename"), nulls.alias("_nulls"), moment.alias("_ts"))
        rows = part if rows is None else rows.unionByName(part)
    timed = (F.hour("_ts") != 0) | (F.minute("_ts") != 0)
    daily = rows.groupBy("filename", F.to_date("_ts").alias("_day")).agg(F.count(F.lit(1)).alias("_n"), F.sum("_nulls").alias("_nulls"), F.max(timed).alias("_timed"))
    gap = F.datediff("_day", F.lag("_day").over(Window.partitionBy("filename").orderBy("_day")))
    g = daily.withColumn("_gap", gap).groupBy("filename").agg(
        F.sum("_n").alias("rows"), F.sum("_nulls").alias("total_nulls"), F.min("_day").alias("date_min"), F.max("_day").alias("date_max"),
        F.count("_day").alias("distinct_dates"), F.max("_timed").alias("_timed"), F.median("_gap").alias("_median"))
    known = spark.createDataFrame(meta, "filename string, cols int, columns string, date_columns string")
    out = known.join(g, "filename", "left").na.fill(0, subset=["rows", "total_nulls", "distinct_dates"])
    out = (out.withColumn("missing_date_count", F.datediff("date_max", "date_min") + 1 - F.col("distinct_dates"))
           .withColumn("granularity", granularity_label(F.coalesce("_timed", F.lit(False)), F.col("_median"))).withColumn("datastream", classify_stream("filename")))
    return out.withColumn("stream_group", stream_group("datastream")).select(
        "filename", "rows", "cols", "columns", "date_columns", "date_min", "date_max", "distinct_dates", "missing_date_count",
        "granularity", "total_nulls", "datastream", "stream_group")


def stream_of_name(name: str, keys=STREAM_KEYS) -> str:
    """R7 on the driver for file names (metadata): first key contained, else 'unknown'."""
    low = name.lower()
    return next((k for k, _ in keys if k in low), "unknown")


def profile_files(spark, paths: Sequence[str]) -> dict[str, DataFrame]:
    """R1-R10 over raw CSV extracts: inventory, drift and overlap reports.

    ``paths`` may hold files, folders and globs.  One tagged scan per header
    group (``read_tagged``).  Date columns are detected per header group (R1);
    each file's first date column feeds one ``groupBy(file)`` for row counts,
    nulls and date ranges, the granularity rule (R2) and the pairwise overlap
    report within each datastream (R9, dates compared as dates).
    """
    from martline.sources.files import list_files, read_tagged
    tagged, headers = read_tagged(spark, paths)
    files = {f.name: f for f in list_files(spark, paths)}
    by_header: dict[tuple[str, ...], list[str]] = {}
    for f, h in headers.items():
        by_header.setdefault(h, []).append(f)
    ts, found = None, {}
    for h, group in sorted(by_header.items()):
        part = tagged.where(F.col("_source_file").isin(group)).select(*h)
        dates = {r.column_name for r in detect_date_columns(part, list(h)).collect() if r.is_date}
        found.update({f: [c for c in h if c in dates] for f in group})
        if not dates:
            continue
        first = [c for c in h if c in dates][0]
        expr = F.when(F.col("_source_file").isin(group), parse_any(F.col(first)))
        ts = expr if ts is None else F.coalesce(ts, expr)
    rows = [(f, files[f].path, "." + f.rsplit(".", 1)[-1] if "." in f else "", files[f].size, len(h), "; ".join(h), "; ".join(found[f]),
             stream_of_name(f), dict(STREAM_KEYS).get(stream_of_name(f), "unknown")) for f, h in sorted(headers.items())]
    meta = spark.createDataFrame(rows, "file string, path string, format string, size_bytes bigint, n_columns int, columns string, "
                                       "date_columns string, stream string, stream_group string")
    # a column a file does not have is no null of it
    nulls = None
    for h, group in sorted(by_header.items()):
        n = F.lit(0)
        for c in h:
            n = n + F.col(c).isNull().cast("bigint")
        part = F.when(F.col("_source_file").isin(group), n)
        nulls = part if nulls is None else F.coalesce(nulls, part)
    base = tagged.select(F.col("_source_file").alias("file"), nulls.alias("_nulls"),
                         (ts if ts is not None else F.lit(None).cast("timestamp")).alias("_ts"))
    dates = base.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("_nulls").alias("total_nulls"), F.min(F.to_date("_ts")).alias("date_min"),
        F.max(F.to_date("_ts")).alias("date_max"), F.count_distinct(F.to_date("_ts")).alias("distinct_dates"))
    dates = dates.withColumn("missing_date_count",
                             F.datediff("date_max", "date_min") + 1 - F.col("distinct_dates"))
    gran = granularity(base.where(F.col("_ts").isNotNull()), "_ts", ["file"]).select("file", "granularity")
    inventory = (meta.join(dates, "file", "left").join(gran, "file", "left")
                 .na.fill("unknown", subset=["granularity"]).na.fill(0, subset=["n_rows", "total_nulls"]))
    drift = drift_report_tagged(tagged, "_source_file", headers, stream_of_name)
    keyed = base.where(F.col("_ts").isNotNull()).join(F.broadcast(meta.select("file", "stream")), "file")
    return {"inventory": inventory, "drift": drift, "overlap": overlap_report(keyed, "file", "_ts", ["stream"])}
