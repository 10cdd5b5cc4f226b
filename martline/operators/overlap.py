"""Overlapping-extract removal (S3, P7, T2) and period expansion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_overlap(df: DataFrame, source_col: str, source: str, date_col: str,
                 start: str, end: str) -> DataFrame:
    """Drop rows of one extract whose date falls in [start, end].

    The rule targets a single source so the other extract keeps its copy of
    the overlap window.  A pure filter: it fuses into the scan stage and the
    date predicate is pushed to the reader when ``date_col`` is stored.  Rows
    without a date are outside every window and stay.
    """
    d = F.to_date(F.col(date_col))
    in_window = d.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return df.filter(~F.coalesce((F.col(source_col) == F.lit(source)) & in_window, F.lit(False)))


def expand_period(df: DataFrame, start_col: str, days: int, flow_cols: Sequence[str],
                  stock_cols: Sequence[str] = (), out_col: str = "date") -> DataFrame:
    """One row per day of a ``days``-long period.

    Flow metrics are spread uniformly (``/days``, as DOUBLE), stock metrics
    are carried unchanged.  ``explode(sequence)`` is a narrow operator: no
    shuffle, the ×days growth happens inside the scan stage.  A row without
    a start keeps its whole flow on one row with a null date.
    """
    seq = F.sequence(F.col(start_col), F.date_add(F.col(start_col), days - 1))
    out = df.select("*", F.explode_outer(seq).alias(out_col))
    share = F.when(F.col(out_col).isNull(), F.lit(1.0)).otherwise(F.lit(float(days)))
    for c in flow_cols:
        out = out.withColumn(c, F.col(c).cast("double") / share)
    return out
