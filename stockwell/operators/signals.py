"""Failure signals in one normal form."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwell.functions import iso_timestamp, run_timestamp


def normalize_signals(signals: DataFrame, platform: str, moment: dt.datetime) -> DataFrame:
    """One record per signal, stamped with ``moment``; absent lists become empty."""
    no_texts = F.array().cast("array<string>")
    no_config = F.create_map().cast("map<string,string>")
    return signals.select(
        F.lit(platform).alias("platform"),
        "job_id",
        "run_id",
        iso_timestamp(run_timestamp(moment)).alias("timestamp"),
        "error_signature",
        "log_excerpt",
        F.coalesce("artifacts", no_texts).alias("artifacts"),
        F.coalesce("code_paths", no_texts).alias("code_paths"),
        F.coalesce("config", no_config).alias("config"),
    )
