"""Column expressions. Everything here stays inside JVM code generation."""

from stockwell.functions.casts import cast_errors
from stockwell.functions.dates import (
    day_gap,
    days_before,
    iso_timestamp,
    month_gap,
    months_before,
    run_timestamp,
)
from stockwell.functions.ladders import abc_class, ltv_tier, revenue_tier
from stockwell.functions.numbers import (
    divide,
    greatest_strict,
    least_strict,
    population_variance,
    retention,
    round_half_even,
)

__all__ = [
    "abc_class",
    "cast_errors",
    "day_gap",
    "days_before",
    "divide",
    "greatest_strict",
    "iso_timestamp",
    "least_strict",
    "ltv_tier",
    "month_gap",
    "months_before",
    "population_variance",
    "retention",
    "revenue_tier",
    "round_half_even",
    "run_timestamp",
]
