"""Exact statistics. Results are rounded half to even, as the marts define them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct(value: Column | str, q: int) -> Column:
    """Inclusive linear interpolation; one value is its own percentile, none gives null.

    Values of seconds have percentiles in hundredths, so six digits hold the exact result without noise of doubles.
    """
    return F.round(F.percentile(value, F.lit(q / 100)), 6)


def pct_int(value: Column | str, q: int) -> Column:
    return F.bround(pct(value, q), 0).cast("int")


def cov(value: Column | str) -> Column:
    """Population deviation over mean; null below two values or at a mean of zero."""
    return F.when((F.count(value) >= 2) & (F.avg(value) != 0), F.stddev_pop(value) / F.avg(value))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of the values that aren't null; null without weight."""
    has = F.when(value.isNotNull(), weight)
    return F.sum(value * has) / F.nullif(F.sum(has), F.lit(0))


def clean(value: Column | str, digits: int | None = None) -> Column:
    """null for NaN and infinities, rounded half to even."""
    c = F.col(value) if isinstance(value, str) else value
    c = F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)
    return c if digits is None else F.bround(c, digits)


def true(value: Column | str) -> Column:
    """Null for the empty string."""
    return F.nullif(F.col(value) if isinstance(value, str) else value, F.lit(""))
