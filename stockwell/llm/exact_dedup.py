"""Exact duplicates with a heavy-hitter split, in DataFrame operations only.

1. Each text's digest is computed once and written with its id to the shared
   folder; all later steps read these narrow rows, never the texts.
2. A mergeable frequent-items sketch (Spark's ``approx_top_k``, of the
   Misra-Gries family) names at most ``max_winners`` candidate digests. Whatever
   holds more than 1 / ``tracked`` of the rows is among the tracked items.
3. Candidates are verified by an exact map-side combined count, and only those
   above ``heavy_share`` of the rows become winners: at most 1 / heavy_share, a
   proven bound, so they are broadcast and their rows are decided in place.
4. All other digests are below that share and use an ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockwell.llm.common import (
    SPACE,
    built_side,
    every_column,
    fresh_name,
    quoted,
    whole_text,
    without_ids,
    written,
)

#: A digest with this share of all rows is decided without a shuffle.
HEAVY_SHARE = 0.001
#: Items the sketch tracks; the guarantee needs more than 1 / HEAVY_SHARE.
TRACKED = 4096


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text_sha256`` of the text with each white-space run as one space."""
    normal = F.regexp_replace(whole_text(text_col), SPACE, " ")
    return docs.select(F.col(id_col).alias("doc_id"), F.sha2(normal, 256).alias("text_sha256"))


def heavy_digests(hashed: DataFrame, share: float = HEAVY_SHARE, tracked: int = TRACKED) -> DataFrame:
    """``text_sha256``, ``keep_id``, ``group_size`` of digests above ``share`` of the rows."""
    limit = min(tracked, int(1 / share) + 1)
    top = hashed.agg(F.expr(f"approx_top_k(text_sha256, {limit}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n"))
    found = top.select(F.explode_outer("top").alias("t"), "n").select(F.col("t.item").alias("text_sha256"), "n")
    spark = hashed.sparkSession
    candidates = [(r["text_sha256"], r["n"]) for r in found.collect() if r["text_sha256"] is not None]
    rows = candidates[0][1] if candidates else 0
    names = spark.createDataFrame([(c,) for c, _ in candidates], "text_sha256 string")
    return (
        hashed.join(F.broadcast(names), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where((F.col("group_size") > 1) & (F.col("group_size") > share * rows))
    )


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    heavy_share: float = HEAVY_SHARE,
    tracked: int = TRACKED,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Of equal texts the smallest id stays; a null id is larger than any other.
    Null and empty texts are equal. Of rows that repeat both id and text exactly
    one is kept. An empty table gives no rows; other columns are not read.
    """
    hashed = written(digests(docs, id_col, text_col), "digests")
    winners = written(heavy_digests(hashed, heavy_share, tracked), "heavy")
    heavy = hashed.join(F.broadcast(winners), "text_sha256", "left")
    in_place = heavy.where(F.col("group_size").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    of_winner = heavy.where(F.col("group_size").isNotNull() & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    rest = heavy.where(F.col("group_size").isNull()).select("doc_id", "text_sha256")

    same = Window.partitionBy("text_sha256")
    first = F.row_number().over(same.orderBy(F.col("doc_id").asc_nulls_last())) == 1
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return (
        in_place.withColumn("kept", F.lit(False)).select(columns)
        .union(of_winner.withColumn("kept", first).select(columns))
        .union(
            rest.select(
                "doc_id",
                F.min("doc_id").over(same).alias("keep_id"),
                F.count(F.lit(1)).over(same).alias("group_size"),
                first.alias("kept"),
                "text_sha256",
            )
        )
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, which may have any name."""
    decided = written(exact_duplicates(docs, id_col, text_col, **options), "exact")
    dropped = decided.where(~F.col("kept")).select(F.col("doc_id").alias(id_col))
    kept = decided.where("kept").select(F.col("doc_id").alias(id_col))
    mine, theirs = dropped[quoted(id_col)], kept[quoted(id_col)]
    repeated = written(dropped.join(kept, mine.eqNullSafe(theirs), "left_semi").distinct(), "repeated")
    if repeated.isEmpty():
        return without_ids(docs, dropped, id_col, nulls=True)
    # An id with both a kept and a dropped row repeats itself; keep one row of each text.
    own, digest = fresh_name(docs, "id"), fresh_name(docs, "digest")
    once = without_ids(without_ids(docs, repeated, id_col, nulls=True), dropped, id_col, nulls=True)
    again = built_side(repeated.withColumnRenamed(id_col, own))
    twice = docs.join(again, docs[quoted(id_col)].eqNullSafe(again[own]), "left_semi")
    normal = F.sha2(F.regexp_replace(F.coalesce(F.col(quoted(text_col)), F.lit("")), SPACE, " "), 256)
    twice = twice.withColumn(digest, normal).dropDuplicates([id_col, digest])
    winners = decided.where("kept").select(F.col("doc_id").alias(own), F.col("text_sha256").alias(f"{digest}_kept"))
    twice = twice.join(
        winners,
        twice[quoted(id_col)].eqNullSafe(winners[own]) & (twice[quoted(digest)] == winners[f"{digest}_kept"]),
        "left_semi",
    )
    return once.union(twice.select(*every_column(docs)))
