"""Checks around a load: safe casts, canaries, lag, completeness, freshness."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwell.functions import cast_errors, run_timestamp

ERRORS = "_errors"


def safe_cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns without failing; ``_errors`` names those that could not be.

    Columns left out of ``types`` pass through. A value that fails is NULL.
    """
    errors = cast_errors({c: F.col(c) for c in types}, types)
    return df.select(
        *[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns],
        errors.alias(ERRORS),
    )


def split_cast(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows cast to ``types``, original rows that would not cast with errors)."""
    cast = safe_cast(df, types)
    good = cast.filter(F.size(ERRORS) == 0).drop(ERRORS)
    marked = df.withColumn(ERRORS, cast_errors({c: F.col(c) for c in types}, types))
    return good, marked.filter(F.size(ERRORS) > 0)


def missing_rows(expected: DataFrame, actual: DataFrame, keys) -> DataFrame:
    """Rows of ``expected`` whose key never reached ``actual``; a NULL key is a key like any other."""
    seen = actual.select(*[F.col(k).alias(f"_seen_{k}") for k in keys]).distinct()
    same = [expected[k].eqNullSafe(seen[f"_seen_{k}"]) for k in keys]
    return expected.join(seen, reduce(lambda a, b: a & b, same), "left_anti")


def skipped_updates(raw: DataFrame, curated: DataFrame) -> DataFrame:
    """Ids whose newest RAW event is newer than the newest CURATED one; a NULL id is an id like any other."""
    newest_raw = raw.groupBy("id").agg(F.max("event_ts").alias("raw_ts"))
    newest_curated = curated.groupBy("id").agg(F.max("event_ts").alias("curated_ts"))
    newest_curated = newest_curated.withColumnRenamed("id", "_id")
    joined = newest_raw.join(newest_curated, F.col("id").eqNullSafe(F.col("_id")), "left").drop("_id")
    return joined.filter(F.col("curated_ts").isNull() | (F.col("raw_ts") > F.col("curated_ts")))


def canary(expected: DataFrame, actual: DataFrame, keys) -> DataFrame:
    """One row: rows expected, rows arrived, keys missing."""
    key_list = list(keys)
    sent = expected.select(*key_list, F.lit(1).alias("_expected"), F.lit(0).alias("_actual"))
    arrived = actual.select(*key_list, F.lit(0).alias("_expected"), F.lit(1).alias("_actual"))
    # Grouping puts NULL keys together, which a join would not.
    by_key = sent.union(arrived).groupBy(*key_list).agg(
        F.sum("_expected").alias("_expected"), F.sum("_actual").alias("_actual")
    )
    return by_key.agg(
        F.coalesce(F.sum("_expected"), F.lit(0)).alias("expected_rows"),
        F.coalesce(F.sum("_actual"), F.lit(0)).alias("actual_rows"),
        F.count_if(F.col("_actual") == 0).alias("missing_keys"),
    )


def stream_lag(raw: DataFrame, curated: DataFrame, max_lag_seconds: int) -> DataFrame:
    """Lag in time and rows between RAW and CURATED, and the retry gate.

    Both sides are tagged and read once in a single global aggregate.
    """
    tagged = raw.select("event_ts", F.lit(True).alias("_raw")).unionByName(
        curated.select("event_ts", F.lit(False).alias("_raw"))
    )
    sums = tagged.agg(
        F.max(F.when(F.col("_raw"), F.col("event_ts"))).alias("raw_max_ts"),
        F.max(F.when(~F.col("_raw"), F.col("event_ts"))).alias("curated_max_ts"),
        (F.count_if(F.col("_raw")) - F.count_if(~F.col("_raw"))).alias("backlog_rows"),
    )
    seconds = F.timestamp_diff("SECOND", F.col("curated_max_ts"), F.col("raw_max_ts"))
    return sums.withColumn("lag_seconds", seconds).withColumn(
        "needs_retry",
        F.col("raw_max_ts").isNotNull()
        & (F.col("curated_max_ts").isNull() | (F.col("lag_seconds") > max_lag_seconds)),
    )


def completeness(manifest: DataFrame, delivered: DataFrame, key: str = "file_name") -> DataFrame:
    """Files announced in ``manifest`` but not delivered, or short of rows.

    ``delivered`` has one row per arrived file or record; with ``row_count`` in
    the manifest the delivered rows are counted too.
    """
    arrived = delivered.groupBy(key).agg(F.count(F.lit(1)).alias("delivered_rows"))
    joined = manifest.join(arrived, key, "left").withColumn(
        "delivered_rows", F.coalesce("delivered_rows", F.lit(0))
    )
    short = F.col("delivered_rows") == 0
    if "row_count" in manifest.columns:
        short = short | (F.col("delivered_rows") < F.col("row_count"))
    return joined.filter(short)


def freshness(events: DataFrame, reference: dt.datetime, max_age_seconds: int) -> DataFrame:
    """One row: newest event, its age at ``reference`` and whether to skip."""
    return with_age(events.agg(F.max("event_ts").alias("newest_ts")), reference, max_age_seconds)


def with_age(newest: DataFrame, reference: dt.datetime, max_age_seconds: int) -> DataFrame:
    """A row with ``newest_ts``, its age at ``reference`` and whether that is too old."""
    age = F.timestamp_diff("SECOND", F.col("newest_ts"), run_timestamp(reference))
    return newest.withColumn("age_seconds", age).withColumn(
        "is_stale", F.col("newest_ts").isNull() | (F.col("age_seconds") > max_age_seconds)
    )
