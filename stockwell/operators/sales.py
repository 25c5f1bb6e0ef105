"""Daily sales: validate staging orders, tier them by amount, stamp the run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwell.functions import revenue_tier
from stockwell.params import SALES_VERSION
from stockwell.schemas import SALES_STAGING


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def require_columns(df: DataFrame, contract: T.StructType = SALES_STAGING) -> DataFrame:
    """``df`` itself, or an error that names every absent column with its type."""
    absent = set(contract.names) - set(df.columns)
    if absent:
        listed = ", ".join(f"{name} {contract[name].dataType.simpleString()}" for name in sorted(absent))
        raise ValueError(f"staging orders lack {listed}")
    return df


def clean_orders(
    staging: DataFrame,
    normalize_first: bool = True,
    before: Observation | None = None,
    after: Observation | None = None,
) -> DataFrame:
    """Rows whose required columns are all present (NULL and NaN are absent).

    ``normalize_first=False`` checks the names as delivered, so upper-case
    columns fail. The observations count rows as they stream past.
    """
    df = lower_names(staging) if normalize_first else staging
    require_columns(df)
    if before is not None:
        df = df.observe(before, F.count(F.lit(1)).alias("rows"))
    kept = df.dropna(subset=SALES_STAGING.names)
    if after is not None:
        kept = kept.observe(after, F.count(F.lit(1)).alias("rows"))
    return kept


def tier_orders(clean: DataFrame, run_date: dt.date, version: str = SALES_VERSION) -> DataFrame:
    """Staging columns plus revenue_tier, pipeline_run_date, pipeline_version."""
    return lower_names(clean).withColumns(
        {
            "revenue_tier": revenue_tier(F.col("total_amount")),
            "pipeline_run_date": F.lit(run_date),
            "pipeline_version": F.lit(version),
        }
    )


def validation_counts(staging: DataFrame) -> DataFrame:
    """Extracted, kept and dropped rows in one pass, without loading them."""
    df = require_columns(lower_names(staging))
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    complete = F.lit(True)
    for name in SALES_STAGING.names:
        complete = complete & F.col(name).isNotNull()
        if name in numeric:
            complete = complete & ~F.isnan(name)
    kept = F.count_if(complete)
    return df.agg(
        F.count(F.lit(1)).alias("rows_extracted"),
        kept.alias("rows_kept"),
        (F.count(F.lit(1)) - kept).alias("rows_dropped"),
    )
