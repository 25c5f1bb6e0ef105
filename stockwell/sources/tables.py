"""Named and path-based table scans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stockwell.schemas import conform
from stockwell.sources.files import path_exists


def scan(spark: SparkSession, name_or_path: str, schema: T.StructType | None = None) -> DataFrame:
    """A catalog table, or a parquet path when the name holds a slash.

    With ``schema`` the scan is projected and cast to that contract.
    """
    df = spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)
    return conform(df, schema) if schema is not None else df


def scan_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return scan(spark, path, schema)


def colocated(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Store ``df`` in ``path`` in hash buckets of ``key``, sorted, and read it so.

    Tables stored by the same key and number of buckets join without moving a row of either.
    The catalog entry is only needed to say how the files lie; it goes, and they stay.
    """
    spark, name = df.sparkSession, f"stockwell_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    stored = spark.table(name)
    # Resolving the plan fixes the files and their buckets before the entry is dropped.
    stored.schema  # noqa: B018
    spark.sql(f"DROP TABLE {name}")
    return stored
