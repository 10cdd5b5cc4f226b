"""Set operators and value inventories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tagged_union(dfs: Mapping[str, DataFrame], cols: Sequence[str], tag: str = "source") -> DataFrame:
    """Union of the same columns from several tables, tagged with the table name."""
    out = None
    for name in sorted(dfs):
        d = dfs[name].select(F.lit(name).alias(tag), *[F.col(c) for c in cols])
        out = d if out is None else out.unionByName(d)
    return out


def distinct_pairs(dfs: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    """Distinct value tuples across many tables."""
    out = None
    for d in dfs:
        p = d.select(*cols)
        out = p if out is None else out.unionByName(p)
    return out.distinct()


def presence_matrix(tagged: DataFrame, value_col: str, tag: str, tags: Sequence[str]) -> DataFrame:
    """For each value, one boolean column per tag telling whether it occurs there."""
    p = (tagged.select(value_col, tag).distinct()
         .groupBy(value_col).pivot(tag, list(tags)).agg(F.count(F.lit(1))))
    return p.select(value_col, *[(F.coalesce(F.col(t), F.lit(0)) > 0).alias(t) for t in tags])


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Full-row (or column subset) duplicates with their multiplicity."""
    cols = list(cols or df.columns)
    return df.groupBy(*cols).count().where(F.col("count") > 1)


def size_histogram(df: DataFrame, key: str, size_name: str = "size") -> DataFrame:
    """A10: how many groups have each size."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(size_name))
            .groupBy(size_name).agg(F.count(F.lit(1)).alias("groups")))


def value_shares(df: DataFrame, col: str, digits: int = 2) -> DataFrame:
    """Value counts and percent of all rows (nulls excluded like pandas)."""
    c = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    c = with_total(c, "n", "_total")
    return c.withColumn("pct", F.round(F.col("n") * 100.0 / F.col("_total"), digits)).drop("_total")


def with_total(df: DataFrame, col: str, out: str) -> DataFrame:
    """Attach the grand total of ``col`` to every row.

    The total is a one-row aggregate joined on a constant key (a broadcast
    hash join of one row), instead of an unpartitioned window that would pull
    every row into one task.
    """
    total = df.agg(F.sum(F.col(col)).alias(out)).withColumn("_one", F.lit(1))
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").drop("_one")
