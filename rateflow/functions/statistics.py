"""Numeric expressions which never raise under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rateflow.functions.coercion import nan_to_null


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient; NULL when the divisor is zero, either side is NULL, or it is NaN."""
    return nan_to_null(F.try_divide(numerator, denominator))


def paired_count(x: Column, y: Column) -> Column:
    """Rows on which both sides are present; NaN is not."""
    return F.count(F.when(nan_to_null(x).isNotNull() & nan_to_null(y).isNotNull(), 1))


def pearson(x: Column, y: Column) -> Column:
    """Correlation over complete pairs; NULL for no spread or under two pairs.

    The built-in ``corr`` raises on zero variance under ANSI mode, so the
    quotient is written out. Both sides are masked to complete pairs, or the
    two deviations would be taken over different rows.
    """
    complete = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(complete, x), F.when(complete, y)
    quotient = ratio(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))
    bounded = F.least(F.greatest(nan_to_null(quotient), F.lit(-1.0)), F.lit(1.0))
    return F.when(quotient.isNotNull() & ~F.isnan(quotient), bounded)
