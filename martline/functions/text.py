"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_key(s) -> Column:
    """F8: lower-case, collapse double spaces, strip."""
    return F.lower(F.trim(F.regexp_replace(_c(s), "  ", " ")))


def remainder_after_first_space(s) -> Column:
    """text after the first space; null when there is none."""
    v = F.regexp_extract(_c(s), r"^\S+ (.*)$", 1)
    return F.when(v == "", F.lit(None).cast("string")).otherwise(v)


def remainder_after_first_dash(s) -> Column:
    """Part after the first '-', or the whole value when no '-'."""
    return F.regexp_replace(_c(s), r"^[^-]*-", "")


def contains_any(s, terms) -> Column:
    """case-sensitive substring test against a small fixed list."""
    col = _c(s)
    expr = F.lit(False)
    for t in terms:
        expr = expr | col.contains(t)
    return expr


def word_match(s, term_col) -> Column:
    """whole-word, case-sensitive regex match of a term held in a column."""
    pattern = F.concat(F.lit(r"\b"), F.regexp_replace(_c(term_col), r"([^A-Za-z0-9 ])", r"\\$1"),
                       F.lit(r"\b"))
    return F.regexp_like(_c(s), pattern)


def is_two_letter_code(s) -> Column:
    """exactly two upper-case letters."""
    return F.coalesce(_c(s).rlike("^[A-Z]{2}$"), F.lit(False))
