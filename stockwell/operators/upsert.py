"""Keyed upsert as a full outer join, with the action taken per row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LTV_COMPARE = ("ltv_score", "ltv_tier", "predicted_revenue_12m", "churn_risk_score")
# sku is written on update but a change of sku alone is not a change.
REORDER_COMPARE = ("reorder_qty", "reorder_point", "safety_stock", "abc_class", "current_stock")

ACTION = "_action"


def rows_differ(pairs: Sequence[tuple[Column, Column]], null_safe: bool = False) -> Column:
    """True where any pair differs.

    By default a NULL on either side is no difference, as with SQL ``<>``.
    """
    if null_safe:
        tests = [~a.eqNullSafe(b) for a, b in pairs]
    else:
        tests = [F.coalesce(a != b, F.lit(False)) for a, b in pairs]
    return reduce(lambda a, b: a | b, tests)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    update: Sequence[str] | None = None,
    null_safe: bool = False,
    cast_before_compare: bool = False,
    newer_by: str | None = None,
    reject_duplicates: bool = False,
    null_keys: bool = False,
    deleted: str | None = None,
    old_image: str | None = None,
) -> DataFrame:
    """The target after merging ``source`` into it, plus ``_action``.

    ``compare=None`` rewrites every matched row. Otherwise a matched row is
    rewritten only where a compared column differs, and keeps all its old
    values, timestamps included, where none does. ``update`` limits the columns
    a match rewrites; an insert always takes every column. Keys must be unique
    on both sides. ``_action`` is inserted, updated or kept.

    ``cast_before_compare=True`` compares values as the target would store
    them, so that rounding on write is not taken for a change. ``newer_by``
    names a column by which a match is rewritten only when the source is newer.
    ``reject_duplicates=True`` fails the job where several source rows match
    one target row; the count shares the exchange and sort of the join.
    ``null_keys=True`` takes a NULL key for a key like any other; else it never matches,
    and its row is inserted again each time. ``deleted`` names a boolean column of the source:
    where it is true, a match becomes ``deleted`` (its row is still returned, as it was) and a
    row without a match is left out. ``old_image`` names a column to add that holds the values
    of the target's row as a struct, NULL where there was none.
    """
    keys = list(keys)
    values = [c for c in target.columns if c not in keys]
    rewritten = list(update) if update is not None else [c for c in values if c in source.columns]
    types = {f.name: f.dataType for f in target.schema.fields}
    old = target.select(
        *keys, *[F.col(c).alias(f"_old_{c}") for c in values], F.lit(True).alias("_in_target")
    )
    new = source.select(
        *[F.col(k).cast(types[k]).alias(k) for k in keys],
        *[F.col(c).alias(f"_new_{c}") for c in values if c in source.columns],
        F.lit(True).alias("_in_source"),
        (F.coalesce(F.col(deleted).cast("boolean"), F.lit(False)) if deleted else F.lit(False)).alias("_gone"),
    )
    if reject_duplicates:
        new = new.withColumn("_copies", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    if null_keys:
        new = new.withColumnsRenamed({k: f"_key_{k}" for k in keys})
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
        joined = old.join(new, same, "full_outer").withColumns({k: F.coalesce(k, f"_key_{k}") for k in keys})
    else:
        joined = old.join(new, keys, "full_outer")

    def incoming(name: str) -> Column:
        return F.col(f"_new_{name}") if name in source.columns else F.lit(None)

    def stored(name: str) -> Column:
        return incoming(name).cast(types[name])

    matched = F.col("_in_target").isNotNull() & F.col("_in_source").isNotNull()
    if compare is None:
        changed = F.lit(True)
    else:
        read = stored if cast_before_compare else incoming
        changed = rows_differ([(F.col(f"_old_{c}"), read(c)) for c in compare], null_safe)
    if newer_by is not None:
        old_mark, new_mark = F.col(f"_old_{newer_by}"), incoming(newer_by)
        changed = changed & new_mark.isNotNull() & (old_mark.isNull() | (new_mark > old_mark))
    if deleted:
        joined = joined.filter(F.col("_in_target").isNotNull() | ~F.col("_gone"))
        going = matched & F.col("_gone")
    else:
        going = F.lit(False)
    action = (
        F.when(F.col("_in_target").isNull(), "inserted")
        .when(going, "deleted")
        .when(matched & changed, "updated")
        .otherwise("kept")
    )
    if reject_duplicates:
        action = F.when(
            matched & (F.col("_copies") > 1),
            F.raise_error(F.lit("several source rows match one target row")).cast("string"),
        ).otherwise(action)
    decided = joined.withColumn(ACTION, action)
    columns = []
    for name in target.columns:
        if name in keys:
            columns.append(F.col(name))
            continue
        takes_new = ("inserted", "updated") if name in rewritten else ("inserted",)
        columns.append(
            F.when(F.col(ACTION).isin(*takes_new), stored(name)).otherwise(F.col(f"_old_{name}")).alias(name)
        )
    if old_image:
        image = F.struct(*[F.col(f"_old_{c}").alias(c) for c in values])
        columns.append(F.when(F.col("_in_target").isNotNull(), image).alias(old_image))
    return decided.select(*columns, ACTION)


def action_counts() -> list[Column]:
    """Aggregates over ``_action``: inserted, updated and merged rows, deletions apart."""
    inserted = F.count_if(F.col(ACTION) == "inserted")
    updated = F.count_if(F.col(ACTION) == "updated")
    return [
        inserted.alias("rows_inserted"),
        updated.alias("rows_updated"),
        (inserted + updated).alias("rows_merged"),
    ]


def upsert_counts(merged: DataFrame) -> DataFrame:
    return merged.agg(*action_counts())
