"""The stage of a job: one write that tells loadable rows from refused ones and sums them up."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwell.schemas import contract_errors
from stockwell.session import new_folder
from stockwell.sources.files import delete_path

REASONS, OUTCOME = "_reasons", "_outcome"
_LOADED, _REFUSED = "loaded", "refused"


@dataclass(frozen=True)
class Stage:
    loadable: DataFrame
    #: Rows the contract refuses, with ``_reasons``; they stay in the shared folder after the job.
    refused: DataFrame
    summary: dict
    path: str

    def drop(self) -> None:
        """Delete the loadable rows; refused ones stay readable."""
        delete_path(self.loadable.sparkSession, f"{self.path}/{OUTCOME}={_LOADED}")


def staged(rows: DataFrame, contract: T.StructType, name: str, summary: Sequence[Column], refuse: bool) -> Stage:
    """Write ``rows`` once, by outcome, and take the summary in the same pass.

    Without ``refuse`` every row counts as loadable, and the target's own checks fail the job.
    """
    spark, seen, path = rows.sparkSession, Observation(), new_folder(rows.sparkSession, name)
    reasons = contract_errors(contract) if refuse else F.array().cast("array<string>")
    judged = rows.observe(seen, *summary).withColumn(REASONS, reasons)
    outcome = F.when(F.size(REASONS) > 0, _REFUSED).otherwise(_LOADED)
    judged.withColumn(OUTCOME, outcome).write.partitionBy(OUTCOME).parquet(path)
    schema = T.StructType([*judged.schema.fields, T.StructField(OUTCOME, T.StringType())])
    stored = spark.read.schema(schema).parquet(path)

    def of(kind: str) -> DataFrame:
        return stored.where(F.col(OUTCOME) == kind).drop(OUTCOME)

    return Stage(of(_LOADED).drop(REASONS), of(_REFUSED), seen.get, path)
