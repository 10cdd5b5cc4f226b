"""Data-quality checks (Q1-Q12).

Every check returns rows ``(check, table_name, status, detail)`` with status
PASS/FAIL, so a suite is a union and its summary a ``groupBy``.  Checks are
aggregates over the tables; bounds and expectations can be DataFrames (one
row) so nothing is collected to the driver to build them.  Unlike the
reference's overlap check, every check here can fail.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.functions.dates import month_key
from martline.functions.numeric import MONEY, formula_mismatch
from martline.operators.joins import null_safe_full_join
from martline.operators.rollup import dealt

OUT = ("check", "table_name", "status", "detail")


def _row(df: DataFrame, check: str, table: str, ok: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.lit(table).alias("table_name"),
                     F.when(ok, "PASS").otherwise("FAIL").alias("status"), detail.cast("string").alias("detail"))


def _combine(parts: Mapping[str, DataFrame]) -> DataFrame:
    """One row holding several one-row aggregates side by side.

    Each part is a one-row aggregate; every part is widened to all columns
    (NULL where it has none), the parts are unioned and folded with ``max``.
    A union and a global aggregate, instead of joins between aggregates.
    """
    cols = [(tag, c, t) for tag in sorted(parts) for c, t in parts[tag].dtypes]
    if len({c for _, c, _ in cols}) != len(cols):
        raise ValueError("column names must be unique across parts")
    u = None
    for tag in sorted(parts):
        row = parts[tag].select(*[(F.col(c) if t == tag else F.lit(None).cast(dt)).alias(c) for t, c, dt in cols])
        u = row if u is None else u.unionByName(row)
    return u.agg(*[F.max(c).alias(c) for _, c, _ in cols])


def check_exists(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q1: table is non-empty (reads at most one row per partition)."""
    out = None
    for name in sorted(tables):
        c = tables[name].limit(1).agg(F.count(F.lit(1)).alias("n"))
        r = _row(c, "exists", name, F.col("n") > 0, F.when(F.col("n") > 0, "non-empty").otherwise("empty"))
        out = r if out is None else out.unionByName(r)
    return out


def duplicate_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows belonging to a key group of size > 1 (all members counted; nulls equal)."""
    return (dealt(df.select(*keys), keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("dups")))


def check_grain(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Q2: declared grain is unique."""
    out = None
    for name in sorted(tables):
        df, keys = tables[name]
        d = duplicate_members(df, keys)
        r = _row(d, "grain", name, F.col("dups") == 0, F.col("dups"))
        out = r if out is None else out.unionByName(r)
    return out


def check_date_range(tables: Mapping[str, tuple[DataFrame, str]], bounds: DataFrame) -> DataFrame:
    """Q3: min date >= start and max date <= end; ``bounds`` is one row (start, end)."""
    out = None
    b = bounds.select(F.col(bounds.columns[0]).alias("_s"), F.col(bounds.columns[1]).alias("_e"))
    for name in sorted(tables):
        df, col = tables[name]
        mm = df.agg(F.min(F.to_date(col)).alias("mn"), F.max(F.to_date(col)).alias("mx"))
        j = _combine({"a": mm, "b": b})
        ok = (F.col("mn") >= F.col("_s")) & (F.col("mx") <= F.col("_e"))
        r = _row(j, "date_range", name, F.coalesce(ok, F.lit(False)),
                 F.concat_ws("..", F.col("mn").cast("string"), F.col("mx").cast("string")))
        out = r if out is None else out.unionByName(r)
    return out


def check_empty_columns(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Q4: columns that are entirely null, except an allow-list (one pass per table)."""
    out = None
    for name in sorted(tables):
        df, allowed = tables[name]
        cols = [c for c in df.columns if c not in set(allowed)]
        counts = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
        empties = F.filter(F.array(*[F.when(F.col(c) == 0, F.lit(c)) for c in cols]), lambda x: x.isNotNull())
        e = counts.select(empties.alias("_e"))
        r = _row(e, "empty_columns", name, F.size("_e") == 0, F.concat_ws(",", F.array_sort("_e")))
        out = r if out is None else out.unionByName(r)
    return out


def check_totals(pairs: Mapping[str, tuple[DataFrame, str, DataFrame, str]], tol: float = 0.01) -> DataFrame:
    """Q5: raw-vs-curated totals agree within ``tol``, which itself passes.

    Sums are exact: values are added as decimals, so no rounding builds up
    however many rows there are.  Spread flows (an amount over 7 days) have
    more than two decimals, hence the finer scale.
    """
    exact = "decimal(38,10)"
    out = None
    for name in sorted(pairs):
        a, ac, b, bc = pairs[name]
        j = _combine({"a": a.agg(F.sum(F.col(ac).cast(exact)).alias("_a")),
                      "b": b.agg(F.sum(F.col(bc).cast(exact)).alias("_b"))})
        diff = F.abs(F.col("_a") - F.col("_b"))
        # compared at the scale of the amounts: decimals of spread flows are no difference
        ok = F.round(diff, 6) <= F.lit(tol).cast("decimal(18,6)")
        r = _row(j, "reconcile", name, F.coalesce(ok, F.lit(False)), F.round(diff, 2).cast(MONEY))
        out = r if out is None else out.unionByName(r)
    return out


def check_expected_rows(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Q6/Q7: observed row count equals an expectation (a one-row, one-column DataFrame)."""
    out = None
    for name in sorted(pairs):
        df, exp = pairs[name]
        j = _combine({"o": df.agg(F.count(F.lit(1)).alias("_o")),
                      "x": exp.select(F.col(exp.columns[0]).cast("bigint").alias("_x"))})
        r = _row(j, "expected_rows", name, F.col("_o") == F.col("_x"),
                 F.concat_ws("/", F.col("_o").cast("string"), F.col("_x").cast("string")))
        out = r if out is None else out.unionByName(r)
    return out


def check_alignment(name: str, source: DataFrame, rollup: DataFrame, key: str,
                    metrics: Sequence[tuple[str, Column, Column]], tol: float = 0.01) -> DataFrame:
    """Per-key totals of a source-grain table equal those of its rollup.

    ``metrics`` is ``(metric, source_expr, rollup_expr)``; both sides are
    aggregated to ``key``, full-outer joined (null keys match each other) and
    mismatching keys counted.
    """
    exact = "decimal(38,10)"
    s = source.groupBy(key).agg(*[e.cast(exact).alias("s_" + m) for m, e, _ in metrics])
    r = rollup.groupBy(key).agg(*[e.cast(exact).alias("r_" + m) for m, _, e in metrics])
    j = null_safe_full_join(s, r, [key])
    aggs = []
    for m, _, _ in metrics:
        a, b = F.col("s_" + m), F.col("r_" + m)
        bad = a.isNull() | b.isNull() | (F.abs(a - b) > F.lit(str(tol)).cast("decimal(18,6)"))
        aggs.append(F.count_if(bad).alias(m))
    counts = j.agg(*aggs)
    out = None
    for m, _, _ in metrics:
        rr = _row(counts, "alignment_" + m, name, F.col(m) == 0, F.col(m))
        out = rr if out is None else out.unionByName(rr)
    return out


def check_overlap(name: str, raw: DataFrame, kept: DataFrame, dropped_filter: Column) -> DataFrame:
    """Q9: rows of all extracts minus rows removed as overlap equals rows kept."""
    j = _combine({"a": raw.agg(F.count(F.lit(1)).alias("_raw"), F.count_if(dropped_filter).alias("_drop")),
                  "b": kept.agg(F.count(F.lit(1)).alias("_kept"))})
    return _row(j, "overlap_removal", name, F.col("_raw") - F.col("_drop") == F.col("_kept"),
                F.concat(F.col("_raw").cast("string"), F.lit("-"), F.col("_drop").cast("string"), F.lit("="),
                         F.col("_kept").cast("string")))


def month_counts(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per calendar month per table: one tagged union, one groupBy."""
    u = None
    for name in sorted(tables):
        df, col = tables[name]
        t = df.select(F.lit(name).alias("table_name"), month_key(F.to_date(col)).alias("month"))
        u = t if u is None else u.unionByName(t)
    return u.groupBy("table_name", "month").agg(F.count(F.lit(1)).alias("n_rows"))


def check_formula(name: str, txn: DataFrame, tol: float = 0.01) -> DataFrame:
    """Line revenue equals quantity*price - discount*quantity within ``tol``."""
    c = txn.agg(F.count_if(formula_mismatch("quantity", "unit_price", "discount_per_unit", "line_revenue", tol))
                .alias("_bad"))
    return _row(c, "revenue_formula", name, F.col("_bad") == 0, F.col("_bad"))


def suite_summary(results: DataFrame) -> DataFrame:
    """Q11: counts per status plus the total."""
    one = results.select(F.explode(F.array("status", F.lit("TOTAL"))).alias("status"), F.lit(1).alias("n"))
    none = results.sparkSession.range(1).select(F.lit("TOTAL").alias("status"), F.lit(0).alias("n"))
    return one.unionByName(none).groupBy("status").agg(F.sum("n").alias("checks"))


def assert_date_range(df: DataFrame, date_col: str, start: str, end: str) -> tuple:
    """Q3, raising variant: one aggregate job; raises ValueError when out of bounds."""
    r = df.agg(F.min(F.to_date(date_col)).alias("mn"), F.max(F.to_date(date_col)).alias("mx")).collect()[0]
    if r.mn is None or str(r.mn) < start or str(r.mx) > end:
        raise ValueError(f"Date range violation: {r.mn} to {r.mx} (expected {start} to {end})")
    return r.mn, r.mx


def check_paths_exist(spark, paths: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """Q1 (existence): each stored table can be opened and has at least one row.

    Opening a path is a metadata step on the driver (file listing); the
    non-empty test reads at most one row per file split.
    """
    rows = []
    frames = {}
    for name in sorted(paths):
        try:
            frames[name] = spark.read.format(fmt).load(paths[name])
        except Exception:  # missing or unreadable path
            rows.append((name,))
    out = check_exists(frames) if frames else None
    if rows:
        missing = spark.createDataFrame(rows, "table_name string").select(
            F.lit("exists").alias("check"), "table_name", F.lit("FAIL").alias("status"),
            F.lit("missing").alias("detail"))
        out = missing if out is None else out.unionByName(missing)
    return out


def check_expected_totals(expected: Mapping[str, tuple[DataFrame, str, float | DataFrame]], tol: float = 0.01) -> DataFrame:
    """Q6: a column total equals an expected value within ``tol``: a published
    constant, or the one value of a one-row DataFrame."""
    out = None
    for name in sorted(expected):
        df, col, value = expected[name]
        t = df.agg(F.sum(F.col(col).cast(MONEY)).alias("_t"))
        if isinstance(value, DataFrame):
            t = _combine({"t": t, "x": value.select(F.col(value.columns[0]).cast("decimal(38,2)").alias("_x"))})
        else:
            t = t.withColumn("_x", F.lit(f"{value:.2f}").cast("decimal(38,2)"))
        diff = F.abs(F.col("_t") - F.col("_x"))
        r = _row(t, "expected_total", name, F.coalesce(diff <= F.lit(str(tol)).cast("decimal(18,6)"), F.lit(False)),
                 F.round(F.col("_t"), 2).cast(MONEY))
        out = r if out is None else out.unionByName(r)
    return out


def check_expected_counts(expected: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """Q7 with literal expectations: observed row count equals a published number."""
    out = None
    for name in sorted(expected):
        df, n = expected[name]
        c = df.agg(F.count(F.lit(1)).alias("_o"))
        r = _row(c, "expected_rows", name, F.col("_o") == F.lit(int(n)),
                 F.concat_ws("/", F.col("_o").cast("string"), F.lit(str(int(n)))))
        out = r if out is None else out.unionByName(r)
    return out
