"""Grouped rollups (A1-A6) — the shape of every daily fact job.

``metrics`` is a list of ``(out_name, kind, column)`` with kind one of
``sum, count, nunique, mean, max, min, first, count_rows``.  ``first`` needs
an ``order_by`` (trap Z3): the first non-null value by that order.

Scale notes: one shuffle on the key set with map-side partial aggregation.
A single ``nunique`` plans as aggregate-by-(keys, value) then count, so a hot
key is spread over the value hash before its final, already-reduced, count.
Where few rows share the keys, ``fine`` deals the rows by them as they are
(:func:`dealt`): one shuffle of plain rows instead of two of wide buffers, of
which a task would hold one for nearly every row before the first.
Several ``nunique`` metrics go through Spark's Expand rewrite (one copy of each
row per distinct metric), again keyed by (keys, value).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.functions.numeric import MONEY


def _metric(kind: str, col: str | None, order_by: Sequence[str] | None, dtype: str = "bigint") -> Column:
    c = F.col(col) if col else None
    if kind == "sum":
        # pandas sums an all-null group to 0 (trap Z19)
        return F.coalesce(F.sum(c), F.lit(0).cast(_sum_result_type(dtype)))
    if kind == "money":
        return F.coalesce(F.sum(c.cast(MONEY)), F.lit(0).cast(MONEY)).cast("double")
    if kind == "count":
        return F.count(c)
    if kind == "count_rows":
        return F.count(F.lit(1))
    if kind == "nunique":
        return F.count_distinct(c)
    if kind == "mean":
        return F.avg(c)
    if kind == "money_mean":
        return F.try_divide(F.sum(c.cast(MONEY)).cast("double"), F.count(c))
    if kind == "max":
        return F.max(c)
    if kind == "min":
        return F.min(c)
    if kind == "first":
        if not order_by:
            raise ValueError("'first' needs order_by (row order is not defined in Spark)")
        # first non-null in order (rows with a null value are skipped); the
        # value itself breaks ties so the choice is the same on every run
        key = F.struct(*[F.col(o) for o in order_by], c.alias("_tie"))
        return F.min_by(c, F.when(c.isNotNull(), key))
    raise ValueError(f"unknown metric kind {kind!r}")


#: Bytes of the tables read for each partition of rows dealt by a fine key.
DEALT_BYTES = 2 << 20


def read_bytes(df: DataFrame) -> int | None:
    """Size of the tables that ``df`` reads, as the optimizer knows it (no job is run); None if it does not."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    except Exception:  # pragma: no cover - plan API not reachable (e.g. Connect)
        return None
    return sum(sizes) if sum(sizes) < 1 << 60 else None  # frames of unknown size say the largest number


def dealt(df: DataFrame, keys: Sequence[str], per_partition: int = DEALT_BYTES, *, like: DataFrame | None = None) -> DataFrame:
    """Rows dealt by hash of ``keys`` over partitions that grow in number with the input, not in size.

    For groupings by keys that hardly repeat: they need no further shuffle,
    and a task's table of groups stays small however large the input.
    ``like`` deals over as many partitions as rows read as that frame are: the
    two can then be joined where they lie.
    """
    size = read_bytes(df if like is None else like)
    cols = [F.col(f"`{k}`") for k in keys]
    return df.repartition(*cols) if size is None else df.repartition(size // per_partition + 1, *cols)


def rollup(df: DataFrame, keys: Sequence[str], metrics: Sequence[tuple[str, str, str | None]],
           keep_null_keys: bool = False, order_by: Sequence[str] | None = None, fine: bool = False) -> DataFrame:
    """Group ``df`` by ``keys`` and compute ``metrics``.

    ``keep_null_keys=False`` reproduces pandas' default (rows with a null
    key vanish, trap Z1); ``True`` keeps null as its own group.  ``fine``
    says that no keys hold much of the table, whose rows are then shuffled once.
    """
    src = df if keep_null_keys else df.na.drop(subset=list(keys))
    dtypes = dict(df.dtypes)
    aggs = [_metric(kind, col, order_by, dtypes.get(col, "bigint")).alias(name)
            for name, kind, col in metrics]
    if fine:
        used = dict.fromkeys([*keys, *(col for _, _, col in metrics if col), *(order_by or ())])
        src = dealt(src.select(*used), keys)
    return src.groupBy(*keys).agg(*aggs)


def _sum_result_type(dtype: str) -> str:
    if dtype.startswith("decimal"):
        return "decimal(38,2)"
    if dtype in ("double", "float"):
        return "double"
    return "bigint"
