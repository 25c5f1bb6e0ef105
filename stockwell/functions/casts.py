"""Casts that name what failed instead of failing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def cast_errors(values: Mapping[str, Column], types: Mapping) -> Column:
    """Names of the values that are present but do not cast to their type."""
    failed = [
        F.when(value.isNotNull() & value.try_cast(types[name]).isNull(), F.lit(name))
        for name, value in values.items()
    ]
    return F.array_compact(F.array(*failed))
