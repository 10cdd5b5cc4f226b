"""Discovery of the minimal keys of a table (E1, E2), level by level.

A set of columns is a key if no two rows agree on all of them (nulls equal);
it is minimal if none of its subsets is one.  Candidates of a level are
counted together: each row is laid out once per candidate as (candidate,
128-bit hash of its values), one shuffle with partial sums brings equal ones
together, and only the largest count per candidate reaches the driver.

Two rules leave candidates out: supersets of a key are not minimal, and a set
whose columns have fewer value combinations than the table has rows (the
product of their distinct counts) can't be a key.

Two rows that agree disprove a candidate wherever they are found, so sets of
several columns are first looked through in one slice of their values' hashes:
all rows are read, equal values fall into the same slice, and only rows of the
slice are shuffled.  What has no such rows there is counted over all values.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from math import prod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: A first look takes one in so many of a candidate's values, by their hash.
SLICES = 256


def _hashes(names: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of the values of some columns, nulls told apart."""
    values = [x for name in names for x in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return F.xxhash64(*values), F.xxhash64(F.lit("second"), *values)


def _disproved(df: DataFrame, candidates: Sequence[tuple[str, ...]]) -> set[tuple[str, ...]]:
    """Candidates on which two rows agree whose hash lies in the first slice; the others may be keys or not."""
    marks = []
    for i, names in enumerate(candidates):
        h1, h2 = _hashes(names)
        marks.append(F.when(F.pmod(h1, F.lit(SLICES)) == 0, F.struct(F.lit(i).alias("c"), h1.alias("h1"), h2.alias("h2"))))
    groups = df.select(F.inline(F.array_compact(F.array(*marks)))).groupBy("c", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    return {candidates[r.c] for r in groups.where("n > 1").select("c").distinct().collect()}


def _counted(df: DataFrame, candidates: Sequence[tuple[str, ...]]) -> dict[tuple[str, ...], tuple[int, int]]:
    """(distinct combinations, rows that share the most frequent one) of each candidate, from one shuffle."""
    marks = []
    for i, names in enumerate(candidates):
        h1, h2 = _hashes(names)
        marks.append(F.struct(F.lit(i).alias("c"), h1.alias("h1"), h2.alias("h2")))
    groups = df.select(F.inline(F.array(*marks))).groupBy("c", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    found = groups.groupBy("c").agg(F.count(F.lit(1)).alias("values"), F.max("n").alias("most")).collect()
    return {candidates[r.c]: (r["values"], r["most"]) for r in found}


def minimal_keys(df: DataFrame, columns: Sequence[str] | None = None, max_size: int = 3, at_once: int = 64) -> list[tuple[str, ...]]:
    """The minimal keys of up to ``max_size`` columns, smaller ones first, in column order; ``at_once`` candidates are counted in a pass.

    A table without rows has the empty key.
    """
    cols = list(df.columns if columns is None else columns)
    n = df.count()
    if n <= 1:
        return [()]
    keys: list[tuple[str, ...]] = []
    distinct: dict[str, int] = {}
    for size in range(1, max_size + 1):
        level = [c for c in itertools.combinations(cols, size)
                 if not any(set(k) <= set(c) for k in keys) and (size == 1 or prod(distinct[x] for x in c) >= n)]
        if size > 1:
            parts = [level[lo:lo + at_once] for lo in range(0, len(level), at_once)]
            disproved = set().union(*[_disproved(df, part) for part in parts])
            level = [c for c in level if c not in disproved]
        for lo in range(0, len(level), at_once):
            for names, (values, most) in sorted(_counted(df, level[lo:lo + at_once]).items(), key=lambda x: level.index(x[0])):
                if size == 1:
                    distinct[names[0]] = values
                if most == 1:
                    keys.append(names)
    return keys


def key_report(spark: SparkSession, tables: dict[str, DataFrame], max_size: int = 3) -> DataFrame:
    """(table_name, key_columns, size) of the minimal keys of several tables."""
    rows = [(name, ",".join(k), len(k)) for name, df in tables.items() for k in minimal_keys(df, max_size=max_size)]
    return spark.createDataFrame(rows, "table_name string, key_columns string, size int")
