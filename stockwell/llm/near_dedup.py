"""Near duplicates by SetSketch bands, likelihood estimates and exact verification.

1. One pass over the texts writes for every document the size and a digest of its
   shingle set, its registers, its band keys and its odd sketch. Equal sets are one
   class from here on, under a number of its own, so copies cost nothing further
   and repeated or null ids change nothing.
2. Classes that share a band key are candidates. A bucket is never expanded into
   all its pairs: first every member is compared with the bucket's leader. Leaders
   are the smallest numbers, one order for all buckets, so the same pair seldom arises twice.
3. A pair whose odd sketches differ in more bits than its sets may differ in elements
   is ruled out for certain. Of the others the registers and set sizes give the likeliest
   similarity; pairs six deviations below the threshold are set aside. All that are left
   are verified on their full shingle sets, which are fetched for candidates only.
4. Verified links form components. In buckets that still hold several components, pairs
   across components are joined under the odd sketch's bound, so that only pairs that
   may reach the threshold become rows, and are compared in the same way. Every
   candidate pair that could change the result is tested.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwell.llm.common import (
    built_side,
    every_column,
    fresh_name,
    map_rows,
    quoted,
    sliced,
    whole_text,
    without_ids,
    written,
)
from stockwell.llm.components import components
from stockwell.llm.setsketch import (
    ODD_WORDS,
    REGISTERS,
    WordHashes,
    band_rows,
    bands,
    likely_similarity,
    odd_sketch,
    registers,
    shingles,
)

#: Pairs estimated this many deviations below the threshold are not verified.
DEVIATIONS = 6
#: Members compared with one copy of a center's shingle set.
MEMBERS_PER_CENTER = 512
#: Texts whose sets or sketches a task holds at once.
TEXTS_AT_A_TIME = 512
_ODD = [f"odd{i}" for i in range(ODD_WORDS)]


def _digest(elements: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None


def sketches(
    docs: DataFrame, width: int, threshold: float, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, digest, registers, bands, odd``; the last four null for empty sets."""
    rows_of_band = band_rows(threshold)

    def sketch(batches):
        hashes = WordHashes()
        for batch in sliced(batches, TEXTS_AT_A_TIME):
            rows = []
            for text in batch.column(1):
                found = shingles(text.as_py(), width, hashes)
                if not len(found):
                    rows.append((0, None, None, None, None))
                    continue
                drawn = registers(found)
                rows.append((len(found), _digest(found), drawn.tobytes(), bands(drawn, rows_of_band), odd_sketch(found)))
            sizes, digests, drawn, keys, odd = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(drawn, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(odd, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "digest", "registers", "bands", "odd"],
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return source.mapInArrow(
        sketch,
        "doc_id long, n_shingles long, digest binary, registers binary, bands array<long>, odd array<long>",
    )


def _bucket_members(classes: DataFrame) -> DataFrame:
    """``key, id, leader`` of every member of a bucket of two or more."""
    placed = classes.select("id", F.explode("bands").alias("key"))
    leaders = (
        placed.groupBy("key")
        .agg(F.min("id").alias("leader"), F.max("id").alias("last"))
        .where("leader < last")
        .select("key", "leader")
    )
    return placed.join(leaders, "key").select("key", "id", "leader")


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether sizes and odd sketches of the rows named ``a`` and ``b`` allow the threshold.

    Sets that share ``percent`` of their union differ in at most
    ``(100 - percent) / (100 + percent)`` of the sum of their sizes.
    """
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = sum((F.bit_count(F.col(f"{a}.{o}").bitwiseXOR(F.col(f"{b}.{o}"))) for o in _ODD), F.lit(0))
    return (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)) & (
        (100 + percent) * differ <= (100 - percent) * (n_a + n_b)
    )


def _estimated(pairs: DataFrame, sketched: DataFrame, percent: int) -> DataFrame:
    """The pairs that may reach the threshold, with their likeliest similarity."""
    threshold = percent / 100
    least = threshold - DEVIATIONS * math.sqrt(threshold * (1 - threshold) / REGISTERS)

    def estimate(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = [batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in (4, 5)]
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                drawn = [
                    np.frombuffer(b"".join(rows.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                    for c in (2, 3)
                ]
                likely = likely_similarity(*drawn, *(x[at : at + 1024] for x in sizes))
                keep = np.flatnonzero(likely >= least)
                rows = rows.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(likely[keep])], names=["a", "b", "likely"]
                )

    def side(name):
        return sketched.select(
            F.col("id").alias(name), F.col("registers").alias(f"r_{name}"), F.col("n").alias(f"n_{name}")
        )

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "r_a", "r_b", "n_a", "n_b").mapInArrow(estimate, "a long, b long, likely double")


def _sets(wanted: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``id, set`` of the wanted classes (``id, digest, doc_id``, the last the smallest id of a text with that set).

    Texts are read by id and matched by digest. Classes that no id names are looked for
    among all texts without one.
    """

    def collect_sets(batches):
        hashes = WordHashes()
        for batch in sliced(batches, TEXTS_AT_A_TIME):
            sets = [shingles(t.as_py(), width, hashes) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["digest", "set"],
            )

    named = wanted.where(F.col("doc_id").isNotNull())
    ids = built_side(named.select("doc_id").distinct())
    found = texts.join(ids, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(
        collect_sets, "digest binary, set binary"
    )
    sets = named.join(found, "digest").select("id", "set")
    unnamed = wanted.where(F.col("doc_id").isNull())
    if not unnamed.isEmpty():
        nameless = texts.where(F.col("doc_id").isNull()).select("doc_id", "text").mapInArrow(
            collect_sets, "digest binary, set binary"
        )
        once = unnamed.join(nameless, "digest").groupBy("id").agg(F.first("set").alias("set"))
        sets = sets.union(once)
    return sets


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold.

    A center's set meets its members' in sorted streams: a task holds one set and
    one batch. A center with many members gets a copy for each 512 of them.
    """
    pairs = written(pairs.select("a", "b"), "pairs")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = written(classes.join(ids, "id", "left_semi").select("id", "digest", "doc_id"), "wanted")
    sets = written(_sets(wanted, texts, width), "sets")

    degree = pairs.groupBy("a").agg(F.ceil(F.count("b") / MEMBERS_PER_CENTER).alias("parts"))
    dealt = pairs.join(degree, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))
    members = dealt.join(sets.withColumnRenamed("id", "b"), "b").select("a", "part", F.lit(1).alias("kind"), "b", "set")
    centers = (
        dealt.select("a", "part").distinct().join(sets.withColumnRenamed("id", "a"), "a")
        .select("a", "part", F.lit(0).alias("kind"), F.col("a").alias("b"), "set")
    )

    def compare(batches):
        center, own = None, None
        for batch in batches:
            found = []
            values = (batch.column(c).to_pylist() for c in (0, 1, 2, 3))
            for a, part, kind, b, data in zip(*values, batch.column(4)):
                elements = np.frombuffer(data.as_buffer(), np.uint64)
                if kind == 0:
                    if (a, part) != center:
                        center, own = (a, part), elements.copy()
                    continue
                small, large = (elements, own) if len(elements) <= len(own) else (own, elements)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                shared = int((large[at] == small).sum())
                if 100 * shared >= percent * (len(own) + len(elements) - shared):
                    found.append((a, b))
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    order = ["a", "part", "kind"]
    stream = centers.union(members).repartition("a", "part").sortWithinPartitions(*order)
    return stream.mapInArrow(compare, "a long, b long")


def _led_pairs(members: DataFrame, sketched: DataFrame, percent: int) -> DataFrame:
    """Distinct possible pairs ``a < b`` of a bucket's leader and another member."""
    pairs = members.where("id != leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    near = pairs.join(sketched.alias("x"), F.col("a") == F.col("x.id")).join(
        sketched.alias("y"), F.col("b") == F.col("y.id")
    )
    return near.where(_possible("x", "y", percent)).select("a", "b")


def _apart(members: DataFrame, labels: DataFrame, sketched: DataFrame, percent: int) -> DataFrame:
    """Distinct possible pairs ``a < b`` of members of one bucket that lie in different components."""
    component = F.coalesce("component", "id").alias("component")
    placed = members.join(labels, F.col("id") == F.col("vertex"), "left").select("key", "id", component)
    split = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    crowded = placed.join(split.where("low != high").select("key"), "key", "left_semi")
    crowded = written(crowded.join(sketched.select("id", "n", *_ODD), "id"), "crowded")
    x, y = crowded.alias("x"), crowded.alias("y")
    met = x.join(
        y,
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.id") < F.col("y.id"))
        & (F.col("x.component") != F.col("y.component"))
        & _possible("x", "y", percent),
    )
    return met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def _classified(
    docs: DataFrame, width: int, percent: int, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame]:
    """(one row per input row: ``doc_id, n_shingles, digest, row``; ``digest, component`` of every class)."""
    drawn = sketches(docs, width, percent / 100, id_col, text_col)
    drawn = written(drawn.withColumn("row", F.monotonically_increasing_id()), "sketches")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    equal = written(
        drawn.where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.min("row").alias("id"), F.min("doc_id").alias("doc_id")),
        "classes",
    )
    own = drawn.join(equal.select(F.col("id").alias("row")), "row", "left_semi").select(
        F.col("row").alias("id"), F.col("n_shingles").alias("n"), "registers", "bands", "odd"
    )
    members = written(_bucket_members(own.select("id", "bands")), "members")
    sketched = written(
        own.join(members.select("id").distinct(), "id", "left_semi").select(
            "id", "n", "registers", *[F.element_at("odd", i + 1).alias(o) for i, o in enumerate(_ODD)]
        ),
        "sketched",
    )

    led = written(_led_pairs(members, sketched, percent), "led")
    links = written(_verified(_estimated(led, sketched, percent), equal, texts, width, percent), "links")
    labels = components(links)
    untested = _apart(members, labels, sketched, percent).join(led, ["a", "b"], "left_anti")
    late = written(_estimated(untested, sketched, percent), "late")
    if not late.isEmpty():
        links = written(links.union(_verified(late, equal, texts, width, percent)), "links")
        labels = components(links)

    component = equal.join(labels, F.col("id") == F.col("vertex"), "left").select(
        "digest", F.coalesce("component", "id").alias("component")
    )
    return drawn.select("doc_id", "n_shingles", "digest", "row"), component


def _decided(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, digest``."""
    rows, component = _classified(docs, width, percent, id_col, text_col)
    placed = written(rows.join(component, "digest", "left"), "placed")
    # The first row of a component: the smallest id, nulls last, and of repeats the one read first.
    first = (
        placed.where(F.col("component").isNotNull())
        .groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")).alias("first"))
        .select("component", F.col("first.doc_id").alias("_id"), F.col("first.row").alias("_row"))
    )
    alone = F.col("component").isNull()
    return placed.join(first, "component", "left").select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_id")).alias("component_id"),
        (alone | (F.col("row") == F.col("_row"))).alias("kept"),
        "digest",
    )


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when their sets of ``width``-word shingles share at least
    ``percent`` of their union; ``component_id`` is the smallest id reachable and
    ``kept`` marks one row that has it. Null and empty texts and texts without words
    have an empty set, no link and stay. Rows that repeat an id are rows of their own:
    of a component exactly one stays. A null id is larger than any other; a component
    without any other id has the component null. An empty table gives no rows; other
    columns are not read.
    """
    return _decided(docs, width, percent, id_col, text_col).drop("digest")


def drop_near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns.

    Rows are matched by id; where an id is null or repeated, by the digest of their set
    too, and rows without any word stay. Columns may have any name.
    """
    decided = written(_decided(docs, width, percent, id_col, text_col), "near")
    removed = decided.where(~F.col("kept")).select(F.col("doc_id").alias(id_col))
    unclear = written(
        decided.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").select(
            F.col("doc_id").alias(id_col)
        ),
        "unclear",
    )
    if unclear.isEmpty():
        return without_ids(docs, removed, id_col)
    clear = without_ids(without_ids(docs, unclear, id_col, nulls=True), removed, id_col)
    again, digest, place = fresh_name(docs, "again"), fresh_name(docs, "digest"), docs.columns.index(text_col)

    def with_digest(batches):
        hashes = WordHashes()
        for batch in sliced(batches, TEXTS_AT_A_TIME):
            digests = pa.array([_digest(shingles(t.as_py(), width, hashes)) for t in batch.column(place)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, digests], names=[*batch.schema.names, digest])

    names = built_side(unclear.withColumnRenamed(id_col, again))
    rows = docs.join(names, docs[quoted(id_col)].cast("long").eqNullSafe(names[again]), "left_semi")
    rows = map_rows(rows.select(*every_column(docs)), with_digest, T.StructField(digest, T.BinaryType()))
    wordless = rows.where(F.col(quoted(digest)).isNull())
    stay = decided.where(F.col("kept") & F.col("digest").isNotNull()).select(
        F.col("doc_id").alias(again), F.col("digest").alias(f"{digest}_kept")
    )
    worded = rows.where(F.col(quoted(digest)).isNotNull()).dropDuplicates([id_col, digest])
    worded = worded.join(
        stay,
        worded[quoted(id_col)].cast("long").eqNullSafe(stay[again])
        & (worded[quoted(digest)] == stay[f"{digest}_kept"]),
        "left_semi",
    )
    columns = [F.col(quoted(c)) for c in docs.columns]
    return clear.union(wordless.select(columns)).union(worded.select(columns))
