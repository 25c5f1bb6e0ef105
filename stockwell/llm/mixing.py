"""Mixing sources to target weights with hash-threshold histograms.

Every document has a place on a 60-bit hash line that depends on its id alone.
A source's budget becomes a threshold on that line: documents below it are
taken once more than the whole number of passes its rate implies. The
threshold is found without sorting. Words are summed by source and hash bucket, the
bucket where the running sum crosses the budget is found, and only that bucket
is divided again, twelve bits at a time. Thresholds are nested: a larger budget takes
a superset of what a smaller one takes, and a rerun takes the same documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwell.llm.common import WORD, every_column, fresh_name, quoted, whole_text, written

#: Bits of the hash line, and bits resolved by one histogram.
HASH_BITS, STEP_BITS = 60, 12
#: A source is taken at most so many times over.
MAX_PASSES = 3
#: More sources than this are refused: one small row of each comes to the driver.
MAX_SOURCES = 100_000
WEIGHTS = (1, 2, 3)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def hash_place(id_column: Column) -> Column:
    """The first 60 bits of the id's MD5, as a number."""
    digits = F.substring(F.md5(F.coalesce(id_column.cast("string"), F.lit(""))), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def source_targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, passes: int = MAX_PASSES) -> dict:
    """Target words of each source, from exact whole-number arithmetic.

    Sources in code-point order, null last, get the weights in turn and share the
    total. A share above ``passes`` times the source's size is cut to that, and
    what is cut is shared again by weight. Taking sources by size per weight
    settles this in one pass: once one is not cut, none after it is.
    """
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weighted = [(name, size, weights[i % len(weights)]) for i, (name, size) in enumerate(ordered)]
    left, weight_left, targets = sum(s for _, s in sizes), sum(w for *_, w in weighted), {}
    pending = sorted(weighted, key=lambda s: s[1] / s[2])
    for i, (name, size, weight) in enumerate(pending):
        if passes * size * weight_left > weight * left:
            for other, _, w in pending[i:]:
                targets[other] = float(w * left) / float(weight_left)
            break
        targets[name] = float(passes * size)
        left -= passes * size
        weight_left -= weight
    return targets


def _thresholds(sized: DataFrame, budgets: list[tuple[str | None, int, float]]) -> list[tuple]:
    """(source, threshold): hashes below it are taken; from nested histograms."""
    spark = sized.sparkSession
    done: dict = {}
    # Of each source: the bits settled so far, the value they have, and words below.
    open_ = {s: (0, 0, 0) for s, _, budget in budgets if budget > 0}
    limit = {s: budget for s, _, budget in budgets}
    schema = T.StructType(
        [
            T.StructField("_source", T.StringType()),
            T.StructField("_prefix", T.LongType(), False),
            T.StructField("_below", T.LongType(), False),
            T.StructField("_budget", T.DoubleType(), False),
        ]
    )
    bits = 0
    while open_ and bits < HASH_BITS:
        # At most MAX_SOURCES rows.
        rows = [(s, value, below, limit[s]) for s, (_, value, below) in open_.items()]
        edges = F.broadcast(spark.createDataFrame(rows, schema))
        shift = HASH_BITS - bits - STEP_BITS
        inside = sized.join(
            edges,
            F.col("source").eqNullSafe(F.col("_source"))
            & (F.shiftright("place", HASH_BITS - bits) == F.col("_prefix")),
        )
        histogram = inside.groupBy(
            "_source", "_below", "_budget", F.shiftright("place", shift).alias("_bucket")
        ).agg(
            F.sum("size").alias("_words"), F.min("place").alias("_low"), F.max("place").alias("_high")
        )
        running = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        before = F.col("_below") + F.coalesce(F.sum("_words").over(running), F.lit(0))
        crossing = (
            histogram.withColumn("_before", before)
            .where((F.col("_before") <= F.col("_budget")) & (F.col("_before") + F.col("_words") > F.col("_budget")))
            .select("_source", "_bucket", "_before", "_words", "_budget", "_low", "_high")
        )
        bits += STEP_BITS
        still, open_ = open_, {}
        for r in crossing.collect():
            source = r["_source"]
            still.pop(source)
            if r["_low"] == r["_high"]:
                nearer = r["_before"] + r["_words"] - r["_budget"] < r["_budget"] - r["_before"]
                done[source] = r["_low"] + int(nearer)
            else:
                open_[source] = (bits, r["_bucket"], r["_before"])
        # No bucket crosses the budget: everything fits.
        done.update({s: 1 << HASH_BITS for s in still})
    return list(done.items())


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    passes: int = MAX_PASSES,
) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, taken``.

    ``size`` counts words of the whole text (null: 0), ``taken`` is how many words
    the mix takes, a multiple of ``size`` up to ``passes`` times. A null source is
    a source of its own and comes last; sources without words have target 0.
    Rows that repeat an id share their place on the hash line and so are taken
    alike. An empty table gives no rows; other columns are not read.
    """
    place = hash_place(F.col(id_col))
    sized = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(whole_text(text_col)).alias("size"),
            place.alias("place"),
        ),
        "sized",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = [(r["source"], r["n"]) for r in totals]
    targets = source_targets(sizes, weights, passes)
    whole = {s: int(targets[s] // n) if n else 0 for s, n in sizes}
    budgets = [(s, n, targets[s] - whole[s] * n) for s, n in sizes]
    thresholds = dict(_thresholds(sized, budgets))
    schema = T.StructType(
        [
            T.StructField("_source", T.StringType()),
            T.StructField("source_size", T.LongType()),
            T.StructField("target", T.DoubleType()),
            T.StructField("_whole", T.LongType()),
            T.StructField("_threshold", T.LongType()),
        ]
    )
    plan = [(s, n, targets[s], whole[s], thresholds.get(s, 0)) for s, n in sizes]
    joined = sized.join(
        F.broadcast(docs.sparkSession.createDataFrame(plan, schema)),
        F.col("source").eqNullSafe(F.col("_source")),
    )
    passes_taken = F.col("_whole") + (F.col("place") < F.col("_threshold")).cast("long")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * passes_taken).alias("taken")
    )


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed table: each row of ``docs`` as often as the mix takes it.

    Rows without words cost nothing and stay once where their id lies below the
    source's threshold, as if they were taken: they are dropped only with a rate of 0.
    Columns may have any name.
    """
    mixed = mix(docs, id_col, text_col, source_col)
    own_id, own_source, times_name, copy = (fresh_name(docs, n) for n in ("id", "source", "times", "copy"))
    passes = F.max(F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(1)).cast("int")
    times = (
        mixed.groupBy(F.col("doc_id").alias(own_id), F.col("source").alias(own_source))
        .agg(passes.alias(times_name))
        .hint("shuffle_hash")
    )
    joined = docs.join(
        times,
        docs[quoted(id_col)].eqNullSafe(times[own_id])
        & docs[quoted(source_col)].cast("string").eqNullSafe(times[own_source]),
    )
    return (
        joined.where(F.col(times_name) > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times_name))))
        .select(*every_column(docs))
    )
