"""Calendar expressions (F1-F7, F18).  All are JVM-side Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The season windows of the marketing calendar, as inclusive
# month-day ranges (MM-dd), checked in this order; anything else is "regular".
DEFAULT_SEASONS = (
    ("back_to_school", "07-15", "09-15"),
    ("black_friday_holiday", "11-15", "12-10"),
)
DEFAULT_SEASON_ELSE = "regular"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_day(ts) -> Column:
    """P5: datetime -> calendar date (midnight truncation)."""
    return F.to_date(_c(ts))


def day_name(d) -> Column:
    return F.date_format(_c(d), "EEEE")


def month_name(d) -> Column:
    return F.date_format(_c(d), "MMMM")


def iso_day_number(d) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(_c(d)) + 1).cast("int")


def week_start(d) -> Column:
    """Monday of the ISO week."""
    return F.to_date(F.date_trunc("week", _c(d)))


def is_weekend(d) -> Column:
    return F.weekday(_c(d)) >= 5


def season_flag(d, seasons=DEFAULT_SEASONS, otherwise: str = DEFAULT_SEASON_ELSE) -> Column:
    """label a date by inclusive month-day windows; first match wins."""
    md = F.date_format(_c(d), "MM-dd")
    expr = None
    for label, start, end in seasons:
        cond = md.between(start, end)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))


def month_key(d) -> Column:
    """A17: 'yyyy-MM' bucket."""
    return F.date_format(_c(d), "yyyy-MM")
