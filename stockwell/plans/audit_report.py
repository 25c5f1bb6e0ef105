"""Audit statistics for a log file or folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stockwell.operators.audit import audit_sets, platforms_of, stats_of
from stockwell.session import materialized
from stockwell.sources.audit_log import read_audit_log


@dataclass(frozen=True)
class AuditReport:
    stats: DataFrame
    platforms: DataFrame


def audit_report(spark: SparkSession, path: str) -> AuditReport:
    """Both results from one scan and parse of the log; a row per platform and one over all are kept."""
    sets = materialized(audit_sets(read_audit_log(spark, path, keep_malformed=True)), "audit")
    return AuditReport(stats_of(sets), platforms_of(sets))
