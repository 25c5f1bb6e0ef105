"""Net changes between two states of a keyed table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwell.sources.files import read_text, write_text

CHANGE = "change_action"
IS_UPDATE = "is_update"


class ChangeStream:
    """The changes of a :class:`BucketedTable`, each delivered once, from a stored position on.

    An interval of versions is written down before it is handed out and becomes the position
    when the handler is done. After a crash in between the same interval comes again under the same
    number, so a handler that writes under that number leaves every change once.
    """

    def __init__(self, table, state: str):
        self.table, self.spark, self.state = table, table.spark, state.rstrip("/")

    def position(self) -> int:
        """The last version whose changes have been consumed."""
        return int(read_text(self.spark, f"{self.state}/position") or 0)

    def pull(self, handler: Callable[[DataFrame, int], None]) -> int:
        """Hand all changes since the position to ``handler(changes, number)``; returns the new position."""
        after = self.position()
        planned = int(read_text(self.spark, f"{self.state}/planned") or 0)
        until = planned if planned > after else self.table.version()
        if until > after:
            write_text(self.spark, f"{self.state}/planned", str(until))
            handler(self.table.changes(after, until), until)
            write_text(self.spark, f"{self.state}/position", str(until))
        return until


def table_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that differ, each tagged INSERT or DELETE.

    An updated row appears twice, as the DELETE of its old image and the
    INSERT of its new one, both with ``is_update`` set. A NULL key is a key like any other.
    """
    keys = list(keys)
    values = [c for c in after.columns if c not in keys]
    old = before.select(*keys, F.struct(*values).alias("_old"))
    new = after.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.struct(*values).alias("_new"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    joined = old.join(new, same, "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new")))
    joined = joined.withColumns({k: F.coalesce(k, f"_key_{k}") for k in keys})
    update = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    images = F.array_compact(
        F.array(
            F.when(F.col("_old").isNotNull(), F.struct(F.lit("DELETE").alias("a"), F.col("_old").alias("r"))),
            F.when(F.col("_new").isNotNull(), F.struct(F.lit("INSERT").alias("a"), F.col("_new").alias("r"))),
        )
    )
    exploded = joined.select(*keys, update.alias(IS_UPDATE), F.explode(images).alias("i"))
    return exploded.select(
        *keys, *[F.col(f"i.r.{c}").alias(c) for c in values], F.col("i.a").alias(CHANGE), IS_UPDATE
    )


def apply_changes(table: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after a change set: deleted keys go, inserted images come in."""
    keys = list(keys)
    touched = changes.select(*keys).distinct()
    matched = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys])
    kept = table.alias("t").join(touched.alias("c"), matched, "left_anti")
    arrived = changes.filter(F.col(CHANGE) == "INSERT").select(*table.columns)
    return kept.unionByName(arrived)
