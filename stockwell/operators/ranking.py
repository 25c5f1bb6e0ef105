"""Global order without a single-task window, on narrow rows.

The rows are written once, numbered, to the shared folder. Only the number, the value and
the tie break are then range-partitioned, sorted within their slice and written with their place in it. The
tie break makes the sort key unique, so a value held by a third of the rows spreads over
many slices. One small row per slice comes to the driver (the number of slices is
bounded by the session's shuffle partitions, never by the data), which turns places in a
slice into global positions. Ties and running totals take a window over each slice. The
wide rows meet the result by their number; several orders share one file of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal, localcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwell.functions import abc_class
from stockwell.params import ABC_THRESHOLDS
from stockwell.schemas import exact
from stockwell.session import materialized, new_folder
from stockwell.sources.tables import colocated

_ROW, _SLICE, _PLACE = "_row", "_slice", "_place"
BUCKETS_PER_SLICE = 4


def _same(a, b) -> bool:
    """Whether two slice edges hold the same value; NaN equals NaN."""
    x, y = a["v"], b["v"]
    if isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y):
        return True
    return x == y


def _tie_starts(slices: DataFrame, value: str, summary: list) -> list[int | None]:
    """Per slice: global position where the tie group of its first value starts,
    if that group began in an earlier slice; otherwise None."""
    continues = [False] + [_same(b["low"], a["high"]) for a, b in zip(summary, summary[1:])]
    if not any(continues):
        return [None] * len(summary)
    # Count the rows tied with the last value, only where a tie crosses a cut.
    spark = slices.sparkSession
    crossing = [
        (s[_SLICE], s["high"]["v"]) for s, nxt in zip(summary, continues[1:] + [False]) if nxt
    ]
    schema = T.StructType(
        [T.StructField(_SLICE, T.IntegerType()), T.StructField("_high", slices.schema[value].dataType)]
    )
    highs = spark.createDataFrame(crossing, schema)
    tied = {
        r[_SLICE]: r["n"]
        for r in slices.join(F.broadcast(highs), _SLICE)
        .filter(F.col(value).eqNullSafe(F.col("_high")))
        .groupBy(_SLICE)
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    starts: list[int | None] = []
    before = 0
    group_start = 1
    for row, carried in zip(summary, continues):
        starts.append(group_start if carried else None)
        end = before + row["n"]
        whole_slice_tied = _same(row["low"], row["high"])
        if not (carried and whole_slice_tied):
            group_start = end - tied.get(row[_SLICE], 0) + 1
        before = end
    return starts


@dataclass(frozen=True)
class Order:
    """One order over a table, and the names of the columns to add from it.

    NULL is the largest value in either direction. ``tie_break`` must make rows unique. A
    NULL adds nothing to the running total, and the share is NULL when the total is
    zero. A value that is no decimal is summed with ``scale`` places, and one that has
    more fails the running job.
    """

    value: str
    tie_break: str | Column
    descending: bool = False
    tie_descending: bool = False
    row_number: str | None = None
    reverse_row_number: str | None = None
    percent_rank: str | None = None
    running_total: str | None = None
    running_share: str | None = None
    scale: int = 4

    @property
    def added(self) -> list[str]:
        names = (self.row_number, self.reverse_row_number, self.percent_rank, self.running_total, self.running_share)
        return [n for n in names if n]

    @property
    def sums(self) -> bool:
        return bool(self.running_total or self.running_share)


def _places(rows: DataFrame, order: Order) -> DataFrame:
    """``_row`` and the added columns of ``order`` over ``rows``, which have a column ``_row``."""
    tie = F.col(order.tie_break) if isinstance(order.tie_break, str) else order.tie_break
    value = F.col(order.value)
    amount = exact(rows, order.value, order.scale) if order.sums else F.lit(0)
    narrow = rows.select(_ROW, value.alias("_value"), tie.alias("_tie"), *([amount.alias("_amount")] * order.sums))
    value_order = F.col("_value").desc_nulls_first() if order.descending else F.col("_value").asc_nulls_last()
    tie_order = F.col("_tie").desc() if order.tie_descending else F.col("_tie").asc()
    sorted_rows = narrow.repartitionByRange(value_order, tie_order).sortWithinPartitions(value_order, tie_order)
    number = F.monotonically_increasing_id()
    placed_rows = sorted_rows.withColumns(
        {_SLICE: F.shiftright(number, 33).cast("int"), _PLACE: number.bitwiseAND((1 << 33) - 1)}
    )
    # Stored by slice, so that what is computed for each slice below moves no row. A slice is one
    # bucket's; with several buckets for each of them few slices share one.
    spark = rows.sparkSession
    buckets = BUCKETS_PER_SLICE * int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = colocated(placed_rows, new_folder(spark, "slices"), _SLICE, buckets)
    key = F.struct(F.col("_value").isNull().alias("missing"), F.col("_value").alias("v"))
    low, high = (F.max(key), F.min(key)) if order.descending else (F.min(key), F.max(key))
    total_type = T.DecimalType(38, slices.schema["_amount"].dataType.scale) if order.sums else T.LongType()
    total = F.coalesce(F.sum("_amount"), F.lit(0)) if order.sums else F.lit(0)
    summary = sorted(
        slices.groupBy(_SLICE)
        .agg(F.count(F.lit(1)).alias("n"), total.cast(total_type).alias("total"), low.alias("low"), high.alias("high"))
        .collect(),
        key=lambda r: r[_SLICE],
    )
    starts = _tie_starts(slices, "_value", summary) if order.percent_rank else [None] * len(summary)

    rows_in_all = sum(r["n"] for r in summary)
    # The columns hold 38 digits, Decimal's default context only 28.
    with localcontext(prec=38):
        grand_total = sum((r["total"] for r in summary), Decimal(0) if order.sums else 0)
        offsets, seen, summed = [], 0, Decimal(0) if order.sums else 0
        for r, start in zip(summary, starts):
            offsets.append((r[_SLICE], seen, summed, r["low"]["v"], start))
            seen += r["n"]
            summed += r["total"]
    schema = T.StructType(
        [
            T.StructField(_SLICE, T.IntegerType()),
            T.StructField("_rows_before", T.LongType()),
            T.StructField("_total_before", total_type),
            T.StructField("_first_value", slices.schema["_value"].dataType),
            T.StructField("_tie_start", T.LongType()),
        ]
    )
    placed = slices.join(F.broadcast(slices.sparkSession.createDataFrame(offsets, schema)), _SLICE)
    position = F.col("_rows_before") + F.col(_PLACE) + 1
    added: dict[str, Column] = {}
    if order.row_number:
        added[order.row_number] = position
    if order.reverse_row_number:
        added[order.reverse_row_number] = F.lit(rows_in_all + 1) - position
    if order.percent_rank:
        # The place in the slice at which the run of equal values begins.
        ties = Window.partitionBy(_SLICE, "_value")
        carried = F.col("_tie_start").isNotNull() & F.col("_value").eqNullSafe(F.col("_first_value"))
        rank = F.when(carried, F.col("_tie_start")).otherwise(F.col("_rows_before") + F.min(_PLACE).over(ties) + 1)
        added[order.percent_rank] = (rank - 1).cast("double") / F.lit(float(max(rows_in_all - 1, 1)))
    if order.sums:
        in_slice = Window.partitionBy(_SLICE).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = F.col("_total_before") + F.coalesce(F.sum("_amount").over(in_slice), F.lit(0))
        if order.running_total:
            added[order.running_total] = running.cast(total_type)
        if order.running_share:
            added[order.running_share] = (
                running.cast("double") / F.lit(float(grand_total))
                if grand_total
                else F.lit(None).cast("double")
            )
    return placed.select(_ROW, *[c.alias(n) for n, c in added.items()])


def with_orders(df: DataFrame, *orders: Order) -> DataFrame:
    """``df`` with the added columns of all ``orders``; a column of the same name is replaced."""
    names = [n for order in orders for n in order.added]
    stage = materialized(df.withColumn(_ROW, F.monotonically_increasing_id()), "ordered")
    result = stage.select(_ROW, *[c for c in df.columns if c not in names])
    for order in orders:
        result = result.join(_places(stage, order), _ROW)
    return result.drop(_ROW)


def ordered(df: DataFrame, value: str, tie_break: str | Column, **options) -> DataFrame:
    """:func:`with_orders` for a single :class:`Order`."""
    return with_orders(df, Order(value, tie_break, **options))


def cumulative_share(df: DataFrame, value: str, tie_break: str) -> DataFrame:
    """Running total of ``value`` from the largest down, and its share."""
    return ordered(
        df,
        value,
        tie_break,
        descending=True,
        running_total="cumulative_revenue",
        running_share="cumulative_revenue_pct",
    )


def abc_classify(df: DataFrame, value: str, tie_break: str, thresholds=ABC_THRESHOLDS) -> DataFrame:
    """Add ``cumulative_revenue_pct`` and ``abc_class`` by share of ``value``."""
    shared = ordered(df, value, tie_break, descending=True, running_share="cumulative_revenue_pct")
    return shared.withColumn("abc_class", abc_class(F.col("cumulative_revenue_pct"), thresholds))
