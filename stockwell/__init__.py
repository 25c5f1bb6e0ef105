"""Retail and event analytics as DataFrame plans.

Sub-packages: ``sources`` (reads), ``functions`` (column expressions),
``operators`` (DataFrame in, DataFrame out), ``sinks`` (writes),
``streaming`` (incremental loads) and ``plans`` (end-to-end jobs).
"""

from stockwell.params import (
    LTV_RUNNER,
    LTV_SQL,
    REORDER_RUNNER,
    REORDER_SQL,
    LtvParams,
    ReorderParams,
)

__all__ = [
    "LTV_RUNNER",
    "LTV_SQL",
    "REORDER_RUNNER",
    "REORDER_SQL",
    "LtvParams",
    "ReorderParams",
]
