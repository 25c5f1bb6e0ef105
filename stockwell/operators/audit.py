"""Incident statistics over the audit log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwell.functions import round_half_even

# Event types of the audit log.
RECEIVED = "event.received"
PR_CREATED = "pr.created"
CLASSIFIED = "error.classified"


def audit_stats(events: DataFrame) -> DataFrame:
    """Totals, success rate in percent and mean confidence in one row.

    The rate divides distinct correlation ids with a created change by the
    number of received events; the two sets are not intersected, so it can
    exceed 100. A missing id counts as one empty id.
    """
    return _rates(events.agg(*_sums()))


def _sums() -> list[Column]:
    kind = F.col("event_type")
    fixed_id = F.when(kind == PR_CREATED, F.coalesce("correlation_id", F.lit("")))
    return [
        F.count_if(kind == RECEIVED).alias("total_incidents"),
        F.count_distinct(fixed_id).alias("incidents_with_pr"),
        F.avg(F.when(kind == CLASSIFIED, F.col("confidence"))).alias("_confidence"),
    ]


def _rates(sums: DataFrame) -> DataFrame:
    rate = F.try_divide(F.col("incidents_with_pr"), F.col("total_incidents")) * 100
    return sums.withColumn("_rate", rate).select(
        "total_incidents",
        "incidents_with_pr",
        F.coalesce(round_half_even(F.col("_rate"), 2), F.lit(0.0)).alias("success_rate"),
        F.coalesce(round_half_even(F.col("_confidence"), 3), F.lit(0.0)).alias("avg_confidence"),
    )


def audit_sets(events: DataFrame) -> DataFrame:
    """The sums of :func:`audit_stats` by platform and over all, from one pass (grouping sets)."""
    sets = events.groupingSets([[F.col("platform")], []], F.col("platform"))
    return sets.agg(F.grouping("platform").alias("_all"), *_sums())


def stats_of(sets: DataFrame) -> DataFrame:
    """:func:`audit_stats` from its grouping sets; zeros for an empty log, which has no set at all."""
    whole = F.col("_all") == 1
    return _rates(
        sets.agg(
            F.coalesce(F.max(F.when(whole, F.col("total_incidents"))), F.lit(0)).alias("total_incidents"),
            F.coalesce(F.max(F.when(whole, F.col("incidents_with_pr"))), F.lit(0)).alias("incidents_with_pr"),
            F.max(F.when(whole, F.col("_confidence"))).alias("_confidence"),
        )
    )


def platforms_of(sets: DataFrame) -> DataFrame:
    """:func:`platform_breakdown` from the grouping sets."""
    named = sets.where((F.col("_all") == 0) & (F.col("total_incidents") > 0))
    return named.select("platform", F.col("total_incidents").alias("incidents"))


def platform_breakdown(events: DataFrame) -> DataFrame:
    """Received events per platform; an explicit null is a platform of its own."""
    return (
        events.filter(F.col("event_type") == RECEIVED)
        .groupBy("platform")
        .agg(F.count(F.lit(1)).alias("incidents"))
    )
