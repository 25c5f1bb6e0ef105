"""Appends, JSON documents and typed batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwell.schemas import conform
from stockwell.sinks.marks import EVENT_TIME, mark_newest
from stockwell.sources.files import path_exists


WRITER, BATCH = "_writer", "_batch"


def append(df: DataFrame, name_or_path: str, partition_by: str | None = None) -> None:
    """Append to a catalog table, or to a parquet folder if the name has a slash.

    A folder that a streaming file sink writes is refused: its readers see only the
    files in the sink's own log. Use :func:`append_batch` for a table of several writers.
    The newest event time is left beside the data (:mod:`stockwell.sinks.marks`).
    """
    if "/" in name_or_path and path_exists(df.sparkSession, f"{name_or_path}/_spark_metadata"):
        raise ValueError(f"{name_or_path} belongs to a streaming file sink, whose readers would not see these rows")
    marked = "/" in name_or_path and EVENT_TIME in df.columns
    if marked:
        seen = Observation()
        df = df.observe(seen, F.max(EVENT_TIME).cast("string").alias("newest_ts"))
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if "/" in name_or_path:
        writer.parquet(name_or_path)
        if marked:
            mark_newest(df.sparkSession, name_or_path, [seen.get["newest_ts"]])
    else:
        writer.saveAsTable(name_or_path)


def append_batch(df: DataFrame, path: str, writer: str, batch: int | str) -> None:
    """Append the rows of one batch of one writer; the same batch again replaces itself.

    Batches lie in folders of their own, so batch jobs and streams share a table.
    """
    marked = df.withColumns({WRITER: F.lit(writer), BATCH: F.lit(str(batch))})
    marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(WRITER, BATCH).parquet(path)


def batch_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches of all writers."""
    marks = [T.StructField(WRITER, T.StringType()), T.StructField(BATCH, T.StringType())]
    return conform(spark.read.schema(T.StructType([*schema.fields, *marks])).parquet(path), schema)


def write_json_documents(df: DataFrame, path: str) -> None:
    """One JSON document per row; the files are written by all tasks."""
    df.write.mode("overwrite").json(path)


def typed_batch(df: DataFrame, schema: T.StructType, view: str) -> DataFrame:
    """Cast a batch to ``schema`` and name it for SQL, without collecting it."""
    batch = conform(df, schema)
    batch.createOrReplaceTempView(view)
    return batch
