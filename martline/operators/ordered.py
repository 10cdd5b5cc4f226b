"""Rolling frames over one global order, without a single task (W1-W3 at event grain).

``rolling_mean`` of ``operators.windows`` needs a partition, or few rows.
Here the rows are numbered in parallel by their order (W7), cut into stretches
of consecutive numbers, and each stretch is given copies of the rows just
outside it that its frames reach (its halo).  A window inside the stretch then
equals the window over the whole order; rows that were only copies are
dropped.  The stretches are as long as the longest frame side or longer, so a
row is copied to its two neighbours at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.operators.quantiles import surrogate_key

STRETCH = 1 << 16


def with_halo(df: DataFrame, order: Sequence, buckets: Sequence[Column], before: int, after: int, stretch: int = STRETCH) -> DataFrame:
    """``df`` plus ``_n`` (its number in the order), ``_s`` (a stretch) and ``_own`` (false for copies from a neighbour)."""
    stretch = max(stretch, before, after, 1)
    numbered = surrogate_key(df, order, "_n", buckets, few_first=True)
    home = F.floor((F.col("_n") - 1) / stretch)
    place = (F.col("_n") - 1) % stretch
    # the last rows of a stretch reach into the next one's frames, its first rows into those of the one before
    homes = F.filter(F.array(home, F.when(place >= stretch - before, home + 1), F.when((place < after) & (home > 0), home - 1)), lambda s: s.isNotNull())
    return numbered.withColumn("_home", home).withColumn("_s", F.explode(homes)).withColumn("_own", F.col("_s") == F.col("_home")).drop("_home")


def frame(window: int, center: bool) -> tuple[int, int]:
    """Rows before and after of a trailing or centred frame (for an even window the extra row lies before)."""
    return (window // 2, (window - 1) // 2) if center else (window - 1, 0)


def rolling_means(df: DataFrame, cols: Sequence[str], order: Sequence, buckets: Sequence[Column], window: int = 7, center: bool = False,
                  min_periods: int | None = None, suffix: str = "_roll", residual: str | None = None, stretch: int = STRETCH) -> DataFrame:
    """W1/W2 (and W3 with ``residual``, a suffix for value minus mean) over all rows in ``order``.

    ``order`` must be total; ``buckets`` are coarse columns that agree with it,
    the first with few values (a month, then a day).  Means are exact sums over counts, null below
    ``min_periods`` values.
    """
    before, after = frame(window, center)
    spread = with_halo(df, order, buckets, before, after, stretch)
    w = Window.partitionBy("_s").orderBy("_n").rowsBetween(-before, after)
    need = window if min_periods is None else min_periods
    out = spread
    for c in cols:
        n = F.count(F.col(c)).over(w)
        mean = F.when(n >= need, F.try_divide(F.sum(F.col(c)).over(w).cast("double"), n))
        out = out.withColumn(c + suffix, mean)
    out = out.where("_own")
    if residual is not None:
        out = out.select("*", *[(F.col(c).cast("double") - F.col(c + suffix)).alias(c + residual) for c in cols])
    return out.drop("_n", "_s", "_own")


def previous_values(df: DataFrame, cols: Sequence[str], order: Sequence, buckets: Sequence[Column], lag: int = 1, suffix: str = "_prev",
                    stretch: int = STRETCH) -> DataFrame:
    """The values ``lag`` rows before, over all rows in ``order``."""
    spread = with_halo(df, order, buckets, lag, 0, stretch)
    w = Window.partitionBy("_s").orderBy("_n")
    out = spread.select("*", *[F.lag(F.col(c), lag).over(w).alias(c + suffix) for c in cols])
    return out.where("_own").drop("_n", "_s", "_own")
