"""Guarded arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockwell.params import ZERO_POLICIES


def divide(
    numerator: Column,
    denominator: Column,
    on_zero: str = "error",
    fallback: Column | None = None,
    what: str = "divisor",
) -> Column:
    """Double division with a stated rule for a zero divisor.

    ``error`` fails the job as the warehouse does, ``null`` yields NULL and
    ``fallback`` yields ``fallback``. A NULL operand always yields NULL.
    """
    if on_zero not in ZERO_POLICIES:
        raise ValueError(f"on_zero must be one of {ZERO_POLICIES}")
    top, bottom = numerator.cast("double"), denominator.cast("double")
    zero = top.isNotNull() & (bottom == 0)
    if on_zero == "error":
        at_zero = F.raise_error(F.lit(f"division by zero: {what}")).cast("double")
    elif on_zero == "null" or fallback is None:
        at_zero = F.lit(None).cast("double")
    else:
        at_zero = fallback.cast("double")
    return F.when(zero, at_zero).otherwise(F.try_divide(top, bottom))


def _strict(function, *columns: Column) -> Column:
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
    return F.when(known, function(*columns))


def least_strict(*columns: Column) -> Column:
    """LEAST that is NULL when any argument is NULL."""
    return _strict(F.least, *columns)


def greatest_strict(*columns: Column) -> Column:
    """GREATEST that is NULL when any argument is NULL."""
    return _strict(F.greatest, *columns)


def population_variance(count: Column, total: Column, total_of_squares: Column) -> Column:
    """Variance from decimal moments.

    The numerator ``n * sum(x^2) - sum(x)^2`` is exact, so the value does not
    depend on the order in which partial aggregates are merged.
    """
    spread = (count * total_of_squares - total * total).cast("double")
    rows = count.cast("double")
    return F.try_divide(spread, rows * rows)


def retention(days_since_last: Column, decay_per_day: float) -> Column:
    return F.exp(F.lit(-decay_per_day) * days_since_last)


def round_half_even(value: Column, digits: int) -> Column:
    """Round the exact binary value, ties to even, as Python's ``round`` does.

    Spark's ``round`` works on the shortest decimal text instead, so 2.675
    becomes 2.68 there and 2.67 here. The rounding error of ``value * 10^n`` is
    recovered exactly by splitting ``value`` into two halves (Dekker 1971), and
    decides which side of a tie the value lies on.
    """
    scale = F.lit(10.0**digits)
    product = value * scale
    spread = value * F.lit(134217729.0)
    high = spread - (spread - value)
    error = (high * scale - product) + (value - high) * scale
    below = F.floor(product).cast("double")
    side = product - below - 0.5
    up = (
        F.when(side > 0, 1.0)
        .when(side < 0, 0.0)
        .when(error > 0, 1.0)
        .when(error < 0, 0.0)
        .otherwise(F.pmod(below, F.lit(2.0)))
    )
    # From 2^52 on a double has no fraction left to round.
    return F.when(F.abs(product) < 2.0**52, (below + up) / scale).otherwise(value)
