"""Landing files to RAW, and RAW to CURATED, each new row once.

Queries run over what has arrived and stop (``availableNow``), so any scheduler
can call them; the checkpoint remembers files and rows already taken.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stockwell.schemas import EVENTS, conform
from stockwell.sinks.buckets import BucketedTable
from stockwell.sinks.marks import EVENT_TIME, mark_newest
from stockwell.sinks.snapshot import SnapshotTable
from stockwell.sinks.writers import append_batch
from stockwell.sources.landing import (
    ERRORS,
    FILE,
    LINE,
    MAX_FILE_AGE,
    file_layouts,
    numbered,
    read_csv,
    read_json,
    text_lines,
    typed_lines,
)

OUTCOME = "outcome"
_LOADED, _QUARANTINED = "loaded", "quarantined"


def _finish(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def load_landing(
    spark: SparkSession,
    landing: str,
    raw: str,
    checkpoint: str,
    schema: T.StructType = EVENTS,
    file_format: str = "csv",
    delimiter: str = ",",
    max_files: int | None = None,
) -> None:
    """Load each landing file once, in one pass over its rows.

    The file sink commits a batch as a whole, so a replay leaves no duplicates.
    Its folder has two partitions: ``outcome=loaded`` is RAW and
    ``outcome=quarantined`` is the quarantine, where the original line and its errors are kept.
    A JSON line must have just the fields of ``schema``, as a CSV line must.
    """
    options = {} if max_files is None else {"maxFilesPerTrigger": str(max_files)}
    if file_format == "csv":
        landed = read_csv(spark, landing, schema, delimiter, streaming=True, options=options)
    else:
        landed = read_json(spark, landing, schema, streaming=True, options=options, missing="error")
    bad = F.size(ERRORS) > 0
    rows = landed.withColumns(
        {
            LINE: F.when(bad, F.col(LINE)),
            ERRORS: F.when(bad, F.col(ERRORS)),
            OUTCOME: F.when(bad, _QUARANTINED).otherwise(_LOADED),
        }
    )
    query = _finish(
        observed(rows, F.when(F.col(OUTCOME) == _LOADED, F.col(EVENT_TIME)) if EVENT_TIME in schema.names else F.lit(None))
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(OUTCOME)
        .option("path", raw)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    mark_newest(spark, raw, [o["newest_ts"] for o in observations(query)])


def load_mixed(
    spark: SparkSession,
    landing: str,
    raw: str,
    quarantine: str,
    checkpoint: str,
    schema: T.StructType = EVENTS,
    writer: str = "landing",
    max_files: int | None = None,
) -> None:
    """Load each landing file once, under its own delimiter and header.

    Every micro-batch finds its files' layouts as a table and splits their lines by it.
    Columns that the contract does not know are kept in the map ``_extra``; files may lack columns.
    Good rows go to ``raw`` and others, as they came, to ``quarantine``, as batches that
    replace themselves when a batch is replayed.
    """
    options = {} if max_files is None else {"maxFilesPerTrigger": str(max_files)}

    def load(batch: DataFrame, number: int) -> None:
        lines = numbered(batch)
        rows = typed_lines(lines, file_layouts(lines, schema), schema, by_name=True).persist()
        try:
            good = F.size(ERRORS) == 0
            append_batch(rows.where(good).drop(ERRORS, LINE, FILE), raw, writer, number)
            append_batch(rows.where(~good).select(FILE, LINE, ERRORS), quarantine, writer, number)
        finally:
            rows.unpersist()

    _finish(
        text_lines(spark, landing, streaming=True, options=options)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def loaded(rows: DataFrame) -> DataFrame:
    """Rows of RAW without the quarantine, if RAW keeps one."""
    return rows.filter(F.col(OUTCOME) == _LOADED) if OUTCOME in rows.columns else rows


def raw_rows(spark: SparkSession, raw: str, schema: T.StructType = EVENTS) -> DataFrame:
    return conform(loaded(spark.read.parquet(raw)), schema)


def quarantine_rows(spark: SparkSession, raw: str) -> DataFrame:
    return spark.read.parquet(raw).filter(F.col(OUTCOME) == _QUARANTINED).select(FILE, LINE, ERRORS)


def raw_stream(
    spark: SparkSession, raw: str, schema: T.StructType = EVENTS, max_files: int | None = None
) -> DataFrame:
    """Rows newly added to a RAW folder, without the quarantine."""
    stored = T.StructType(list(schema.fields) + [T.StructField(OUTCOME, T.StringType())])
    reader = spark.readStream.schema(stored).option("maxFileAge", MAX_FILE_AGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(raw).filter(F.coalesce(OUTCOME, F.lit(_LOADED)) == _LOADED)
    return conform(rows, schema)


def curate_append(
    spark: SparkSession,
    raw: str,
    curated: str,
    checkpoint: str,
    max_files: int | None = None,
    writer: str | None = None,
) -> StreamingQuery:
    """Append every new RAW row to CURATED exactly once.

    With ``writer`` the rows go into that writer's batches (:func:`append_batch`), so that other
    writers can share the table; else the folder belongs to this stream alone. The finished query
    is returned; its progress holds what :func:`observed` adds.
    """
    if writer is not None:
        rows = observed(raw_stream(spark, raw, max_files=max_files))
        return _finish(
            rows.writeStream.foreachBatch(lambda batch, number: append_batch(batch, curated, writer, number))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    return _finish(
        raw_stream(spark, raw, max_files=max_files)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", curated)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


OBSERVED = "events"


def observed(rows: DataFrame, time: str | Column = EVENT_TIME) -> DataFrame:
    """``rows`` that report their number and newest time with each batch's progress."""
    return rows.observe(OBSERVED, F.count(F.lit(1)).alias("rows"), F.max(time).cast("string").alias("newest_ts"))


def observations(query: StreamingQuery) -> list[dict]:
    """What :func:`observed` rows reported, a dict for each batch of the query's recent progress."""
    found = []
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(OBSERVED)
        if row is not None:
            found.append(row.asDict())
    return found


def latest_per_id(events: DataFrame) -> DataFrame:
    """The newest row per id; partial maxima keep a hot id in many tasks."""
    return events.groupBy("id").agg(F.max("event_ts").alias("event_ts"))


def curate_merge(
    spark: SparkSession,
    raw: str,
    curated: SnapshotTable | BucketedTable,
    checkpoint: str,
    max_files: int | None = None,
) -> None:
    """Keep one CURATED row per id, the one with the newest event_ts; NULL ids share one row.

    A row not newer than the stored one does not replace it, so a batch that is
    replayed, or a whole stream started over, changes nothing.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        curated.merge(latest_per_id(batch), owner=checkpoint, newer_by="event_ts")

    _finish(
        raw_stream(spark, raw, max_files=max_files)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
