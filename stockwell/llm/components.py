"""Connected components of a link table, entirely in Spark.

Alternating large-star and small-star steps (Kiveris et al., 2014): every
vertex hangs its larger neighbours on its smallest neighbour, then its smaller
ones. Each step is one aggregate and one join over the current links, the
result is written to the shared folder, and the number of steps grows with the
logarithm of the longest path. A hub's neighbours are never gathered in one
row: the smallest neighbour is a map-side combined minimum, and the join can
be split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwell.llm.common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    if large:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = both.groupBy("a").agg(F.min("b").alias("m"))
    lowest = lowest.withColumn("m", F.least("a", "m"))
    joined = both.join(lowest, "a")
    if large:
        hung = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            joined.select("a", F.col("m").alias("b"))
        )
    return hung.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``vertex``, ``component``: the smallest vertex reachable, for linked vertices.

    Links with a null end or between a vertex and itself add nothing.
    """
    current = written(
        links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") != F.col("b")))
        .distinct(),
        "links",
    )
    state = None
    while True:
        summary = current.agg(
            F.count("a").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
            F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")).alias("g"),
        ).first()
        if tuple(summary) == state or not summary["n"]:
            break
        state = tuple(summary)
        current = written(_star(_star(current, True), False), "links")
    members = current.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
    return members.union(members.select("component", "component").distinct())
