"""Distributed exact median and surrogate keys.

Spark's ``median``/``percentile`` keep a value->count map per group and merge
it in one task, and ``row_number()`` over an unpartitioned window sorts
everything in one task.  Both are fine for bounded inputs (a calendar of
days, a handful of shows) but not for a group that holds a large share of a
100 TB table.  The functions here split the order into ordered buckets that
are an expression of the row (no sampling, no intermediate write, no job
while the plan is built, and the same buckets if a stage is recomputed): only
per-bucket counts (a small table) are combined per group, and ranking happens
inside one bucket at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Buckets per factor of two; a double has at most 2,100 factors of two, so a group has a bounded number of buckets.
BUCKETS_PER_OCTAVE = 1024


def ordered_bucket(v: Column) -> Column:
    """A coarse key that never decreases as a DOUBLE grows (null for null)."""
    size = F.abs(v)
    # log2 of any finite double lies in [-1074, 1024]
    finite = F.floor(F.log2(size) * BUCKETS_PER_OCTAVE).cast("bigint") + F.lit(1100 * BUCKETS_PER_OCTAVE)
    infinite = F.isnan(v) | (size == F.lit(float("inf")))
    step = F.when(infinite, F.lit(3000 * BUCKETS_PER_OCTAVE).cast("bigint")).when(size > 0, finite).otherwise(F.lit(0).cast("bigint"))
    return F.when(F.isnan(v) | (v > 0), step).when(v < 0, -step).when(v == 0, F.lit(0).cast("bigint"))


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null-safe equality of ``names`` with the ``_r_`` columns of ``right``."""
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right["_r_" + n])
    return cond


def exact_median(df: DataFrame, group: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """Exact median of ``value`` per ``group`` (null values ignored, null groups
    kept; mean of the two middle values for an even count), computed without
    putting a group's values into one task."""
    g = list(group)
    vc = (df.select(*g, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
          .groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c")).withColumn("_b", ordered_bucket(F.col("_v"))))
    # per (group, bucket) counts
    pc = vc.groupBy(*g, "_b").agg(F.sum("_c").alias("_cnt"))
    wg = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(1))
    pc = (pc.withColumn("_before", F.coalesce(F.sum("_cnt").over(
            wg.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
          .withColumn("_n", F.sum("_cnt").over(wg)))
    # 0-based ranks of the middle value(s)
    pc = (pc.withColumn("_r1", F.floor((F.col("_n") - 1) / 2))
          .withColumn("_r2", F.ceil((F.col("_n") - 1) / 2)))
    hit = ((F.col("_r1") >= F.col("_before")) & (F.col("_r1") < F.col("_before") + F.col("_cnt"))) | \
          ((F.col("_r2") >= F.col("_before")) & (F.col("_r2") < F.col("_before") + F.col("_cnt")))
    targets = pc.where(hit).select(*[F.col(c).alias("_r_" + c) for c in [*g, "_b"]], "_before", "_r1", "_r2")
    # rank inside the (at most two) buckets that hold the middle of each group
    inside = vc.join(targets, _same(vc, targets, [*g, "_b"])).drop(*["_r_" + c for c in [*g, "_b"]])
    wr = Window.partitionBy(*g, "_b").orderBy("_v")
    inside = inside.withColumn("_upto", F.col("_before") + F.sum("_c").over(
        wr.rowsBetween(Window.unboundedPreceding, 0)))
    inside = inside.withColumn("_from", F.col("_upto") - F.col("_c"))
    v1 = F.when((F.col("_r1") >= F.col("_from")) & (F.col("_r1") < F.col("_upto")), F.col("_v"))
    v2 = F.when((F.col("_r2") >= F.col("_from")) & (F.col("_r2") < F.col("_upto")), F.col("_v"))
    res = inside.groupBy(*g).agg(F.max(v1).alias("_m1"), F.max(v2).alias("_m2"))
    return res.select(*g, ((F.col("_m1") + F.col("_m2")) / 2).alias(out))


def join_median(stats: DataFrame, median: DataFrame, group: str) -> DataFrame:
    """``stats`` with its median column; the null group finds its own."""
    m = median.withColumnRenamed(group, "_r_" + group)
    return stats.join(m, stats[group].eqNullSafe(m["_r_" + group]), "left").drop("_r_" + group)


def _offsets(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """``counts`` plus ``_off``, the rows before each bucket, in two steps: the sums of the first
    column's few values in one row, and a window over the buckets of each of them."""
    top = names[0]
    sums = counts.groupBy(F.col(top).alias("_top")).agg(F.sum("_cnt").alias("_sum"))
    row = sums.agg(F.array_sort(F.collect_list(F.struct("_top", "_sum"))).alias("_all"))  # nulls first, as the keys
    before = F.transform("_all", lambda x, i: F.struct(x["_top"].alias("_top"), F.aggregate(
        F.slice("_all", F.lit(1), i), F.lit(0).cast("bigint"), lambda a, y: a + y["_sum"]).alias("_base")))
    base = row.select(F.inline(before))
    inside = Window.partitionBy(top).orderBy(*[F.col(n).asc_nulls_first() for n in names[1:]])
    local = counts.withColumn("_in", F.coalesce(F.sum("_cnt").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    joined = local.join(base, F.col(top).eqNullSafe(F.col("_top")))
    return joined.withColumn("_off", F.col("_in") + F.col("_base")).drop("_in", "_top", "_base")


def surrogate_key(df: DataFrame, order_cols: Sequence, out: str = "key", buckets: Sequence[Column] | None = None, few_first: bool = False) -> DataFrame:
    """Consecutive keys 1..n in ``order_cols`` order, numbered in parallel.

    ``buckets`` are coarse columns in order, such that sorting by them first
    does not change the order (for example the leading order column, then a
    prefix of the next one).  Rows are numbered inside each bucket, and each
    bucket is offset by the row count of the buckets before it (a table of one
    row per bucket).  The default is the first order column itself, fit for a
    column with many values.  ``order_cols`` must be a total order for the keys
    to be deterministic.  With ``few_first`` the first of several buckets has
    few values (months, files), and offsets are summed per value, so that no
    window spans all buckets.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    coarse = list(buckets) if buckets is not None else [F.col(order_cols[0]) if isinstance(order_cols[0], str) else order_cols[0]]
    names = [f"_b{i}" for i in range(len(coarse))]
    keyed = df.select("*", *[c.alias(n) for c, n in zip(coarse, names)])
    counts = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("_cnt"))
    if few_first:
        offsets = _offsets(counts, names).select(*[F.col(n).alias("_r_" + n) for n in names], "_off")
    else:
        before = Window.partitionBy(F.lit(1)).orderBy(*[F.col(n).asc_nulls_first() for n in names])
        offsets = counts.select(*[F.col(n).alias("_r_" + n) for n in names], F.coalesce(F.sum("_cnt").over(
            before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    local = keyed.withColumn("_r", F.row_number().over(Window.partitionBy(*names).orderBy(*cols)))
    joined = local.join(offsets, _same(local, offsets, names))
    return joined.withColumn(out, (F.col("_off") + F.col("_r")).cast("bigint")).drop("_r", "_off", *names, *["_r_" + n for n in names])
