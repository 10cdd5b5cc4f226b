"""Numeric expressions (F14-F17, F19, F21, A9, A18 guards)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Money is summed exactly as DECIMAL(18,2) (trap Z7)."""
    return _c(c).cast(MONEY)


def as_double(c) -> Column:
    return _c(c).cast("double")


def safe_ratio(num, den, default=0.0) -> Column:
    """Ratio with a zero/null guard (ANSI '/' raises on zero)."""
    r = F.try_divide(as_double(num), as_double(den))
    return r if default is None else F.coalesce(r, F.lit(default))


def pearson(x, y) -> Column:
    """A18 aggregate: population Pearson r, NULL for constant input.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI for a constant series; the
    guarded form returns NULL (numpy would give NaN).
    """
    return F.try_divide(F.covar_pop(_c(x), _c(y)),
                        F.stddev_pop(_c(x)) * F.stddev_pop(_c(y)))


def where_nonzero(cond_col, value) -> Column:
    """F16: value where cond != 0 else null."""
    return F.when(_c(cond_col) != 0, value)


def null_count(c) -> Column:
    """F19."""
    return F.count_if(_c(c).isNull())


def formula_mismatch(q, p, d, revenue, tol: float = 0.01) -> Column:
    """|q*p - d*q - revenue| >= tol."""
    expected = as_double(q) * as_double(p) - as_double(d) * as_double(q)
    return F.abs(expected - as_double(revenue)) >= F.lit(tol)


def attenuation_label(simple, partial) -> Column:
    """Describe how much a correlation weakens after conditioning."""
    att = F.abs(_c(simple)) - F.abs(_c(partial))
    direction = F.when(_c(partial) >= 0, F.lit("positive")).otherwise(F.lit("negative"))
    strength = (F.when(att > 0.15, F.lit("meaningfully weaker"))
                .when(att > 0.05, F.lit("modestly weaker"))
                .otherwise(F.lit("similar")))
    flipped = F.when(F.signum(_c(simple)) * F.signum(_c(partial)) < 0,
                     F.lit(" (sign flipped)")).otherwise(F.lit(""))
    return F.concat(F.lit("relationship is "), direction, F.lit(" and "), strength,
                    F.lit(" after conditioning"), flipped)
