"""RAW to CURATED: full batch append, guarded incremental append, merge."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stockwell.operators.quality import freshness
from stockwell.schemas import EVENTS, conform
from stockwell.sinks.marks import newest_mark
from stockwell.sinks.writers import append, append_batch
from stockwell.sources.tables import scan
from stockwell.streaming.gates import marked_freshness
from stockwell.streaming.ingest import curate_append, loaded


def curate_columns(raw: DataFrame, schema: T.StructType = EVENTS) -> DataFrame:
    return conform(raw, schema)


def curate_full_append(spark: SparkSession, raw: str, curated: str, writer: str | None = None, run: str = "") -> str:
    """Append all loaded rows of RAW to CURATED. Each call appends all rows again.

    With ``writer`` the rows become the batch ``run`` of that writer in a table that streams
    share (:func:`append_batch`); the same run again replaces its batch.
    """
    rows = curate_columns(loaded(scan(spark, raw)))
    if writer is not None:
        append_batch(rows, curated, writer, run)
    else:
        append(rows, curated)
    return "ok"


def curate_changes(changes: DataFrame, curated: str) -> None:
    """Append a change set as it comes: images of deletes and updates too."""
    append(curate_columns(changes), curated)


def guarded_curate_append(
    spark: SparkSession,
    raw: str,
    curated: str,
    checkpoint: str,
    reference: dt.datetime,
    max_age_seconds: int,
) -> bool:
    """Append new rows unless RAW is stale at ``reference``; False if skipped.

    The newest time is the mark that loads leave beside RAW; only an unmarked RAW is scanned.
    """
    if newest_mark(spark, raw) is not None:
        state = marked_freshness(spark, raw, reference, max_age_seconds).first()
    else:
        state = freshness(loaded(scan(spark, raw)), reference, max_age_seconds).first()
    if state["is_stale"]:
        return False
    curate_append(spark, raw, curated, checkpoint)
    return True
