"""Overlapping ranges without comparing all pairs and without a row per day.

Two ranges overlap if and only if the start of one lies in the other.  Points
and ranges meet in cells of a hierarchy: on level k a cell covers ``RADIX ** k``
units of time.  A range is cut into the few largest cells that cover it
exactly (at most ``2 * (RADIX - 1)`` on a level), a point lies in one cell of
every level, and so a point and a range that contains it share exactly one
cell.  The join on cells therefore yields every overlap once and nothing else,
for ranges of microseconds or centuries alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RADIX = 4
#: Bits of a level: cells are found by shifts, which round down on both sides of zero.
BITS = 2
#: Levels that cover all values of a unit: days of a date, microseconds of a timestamp.
LEVELS = {"date": 14, "timestamp": 31}


def units(value: Column, dtype: str) -> tuple[Column, str]:
    """A date as days, a timestamp as microseconds, both as bigint."""
    if dtype == "date":
        return F.unix_date(value).cast("bigint"), "date"
    return F.unix_micros(value.cast("timestamp")), "timestamp"


def point_cells(point: Column, levels: int) -> Column:
    """(level, cell) of a point on every level."""
    cells = [F.struct(F.lit(k).alias("level"), F.shiftright(point, BITS * k).alias("cell")) for k in range(levels)]
    return F.array(*cells)


def range_cells(first: Column, last: Column, levels: int) -> Column:
    """(level, cell) of the cells that cover the units ``first`` to ``last``, both included, exactly."""
    return F.expr(f"""aggregate(sequence(0, {levels - 1}),
      named_struct('lo', _first, 'hi', _last + 1, 'cells', CAST(array() AS array<struct<level:int,cell:bigint>>)),
      (a, k) -> CASE WHEN a.lo >= a.hi THEN a ELSE named_struct(
        'lo', if(shiftright(a.lo + {RADIX - 1}, {BITS}) <= shiftright(a.hi, {BITS}), shiftright(a.lo + {RADIX - 1}, {BITS}), 0L),
        'hi', if(shiftright(a.lo + {RADIX - 1}, {BITS}) <= shiftright(a.hi, {BITS}), shiftright(a.hi, {BITS}), 0L),
        'cells', concat(a.cells, transform(
          if(shiftright(a.lo + {RADIX - 1}, {BITS}) <= shiftright(a.hi, {BITS}),
             concat(filter(sequence(a.lo, a.lo + {RADIX - 1}), c -> c < shiftright(a.lo + {RADIX - 1}, {BITS}) * {RADIX}),
                    filter(sequence(a.hi - {RADIX - 1}, a.hi), c -> c >= shiftright(a.hi, {BITS}) * {RADIX} AND c < a.hi)),
             sequence(a.lo, a.hi - 1)),
          c -> named_struct('level', k, 'cell', c)))) END,
      a -> a.cells)""")


def overlapping(ranges: DataFrame, id_col: str, start_col: str, end_col: str, within: Sequence[str] = ()) -> DataFrame:
    """Pairs of distinct (id, start, end) ranges that share a moment: ``within``, id_a, start_a, end_a, id_b, start_b, end_b, the lesser range first.

    Ranges with a null end or an end before their start overlap nothing; null
    ``within`` values are equal.
    """
    dtype = dict(ranges.dtypes)[start_col]
    (first, unit), (last, _) = units(F.col(start_col), dtype), units(F.col(end_col), dtype)
    levels = LEVELS[unit]
    w = [f"_w{i}" for i in range(len(within))]
    r = (ranges.select(*[F.col(c).alias(n) for c, n in zip(within, w)], F.col(id_col).alias("id"), F.col(start_col).alias("s"), F.col(end_col).alias("e"),
                       first.alias("_first"), last.alias("_last")).where("_first <= _last").distinct())
    one = F.struct("id", "s", "e", "_first")
    spans = r.select(*w, one.alias("a"), F.explode(range_cells(F.col("_first"), F.col("_last"), levels)).alias("c")).select(*w, "a", "c.level", "c.cell")
    points = r.select(*[F.col(n).alias("r" + n) for n in w], one.alias("b"), F.explode(point_cells(F.col("_first"), levels)).alias("c"))
    points = points.select(*["r" + n for n in w], "b", F.col("c.level").alias("_level"), F.col("c.cell").alias("_cell"))
    same = (F.col("level") == F.col("_level")) & (F.col("cell") == F.col("_cell"))
    for n in w:
        same = same & F.col(n).eqNullSafe(F.col("r" + n))
    met = spans.join(points, same)
    # of two ranges with one start each contains the other's: the pair counts once
    met = met.where((F.col("b._first") > F.col("a._first")) | ((F.col("b._first") == F.col("a._first")) & (F.col("a") < F.col("b"))))
    low, high = F.least("a", "b"), F.greatest("a", "b")
    return met.select(*[F.col(n).alias(c) for c, n in zip(within, w)], low.alias("x"), high.alias("y")).select(
        *within, F.col("x.id").alias("id_a"), F.col("x.s").alias("start_a"), F.col("x.e").alias("end_a"), F.col("y.id").alias("id_b"),
        F.col("y.s").alias("start_b"), F.col("y.e").alias("end_b"))
