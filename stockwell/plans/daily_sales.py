"""Daily sales from staging to the fact table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stockwell.operators.sales import clean_orders, tier_orders
from stockwell.sinks.writers import append


def daily_sales_job(
    staging: DataFrame,
    fact: str,
    run_date: dt.date | None = None,
    normalize_first: bool = True,
) -> dict:
    """Validate, tier and append; returns the row counts of each step.

    The rows are read once: counts are observed while they are written.
    """
    run_date = run_date or dt.datetime.now(dt.UTC).date()
    extracted, kept, loaded = Observation(), Observation(), Observation()
    rows = tier_orders(clean_orders(staging, normalize_first, extracted, kept), run_date)
    append(rows.observe(loaded, F.count(F.lit(1)).alias("rows")), fact)
    counts = {
        "rows_extracted": extracted.get["rows"],
        "rows_kept": kept.get["rows"],
        "rows_loaded": loaded.get["rows"],
    }
    counts["rows_dropped"] = counts["rows_extracted"] - counts["rows_kept"]
    return counts
