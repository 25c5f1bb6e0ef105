"""The newest event time of a folder, kept beside its data by the loads that write it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from stockwell.sources.files import read_text, write_text

EVENT_TIME = "event_ts"
#: A small hidden file.
_MARK = "_newest"


def mark_newest(spark: SparkSession, folder: str, times: Iterable[str | None]) -> str | None:
    """Keep the newest of ``times`` and of the folder's mark as the folder's mark, and return it.

    Times are texts such as ``2024-01-31 23:59:59.5``, which sort as the times do.
    """
    path = f"{folder}/{_MARK}"
    old = read_text(spark, path) or None
    newest = max(filter(None, [old, *times]), default=None)
    if newest != old:
        write_text(spark, path, newest)
    return newest


def newest_mark(spark: SparkSession, folder: str) -> str | None:
    """The newest event time committed to a folder by marked loads; no data is read."""
    return read_text(spark, f"{folder}/{_MARK}") or None
