"""Ranked lexical search by pipelined term partitioning, in whole numbers.

Terms belong to owner stages, rare ones to the first and very common ones to the last. A
bundle of items carries a sparse accumulator of document scores for each of its items
through the stages. At every stage the bundle is cogrouped with the postings that the
stage owns, adds their contributions, and goes on to the next owner.

Documents are dealt to shards of bounded size, and a bundle has one copy for each shard, so
neither a frequent term nor an item that meets every document is gathered in one place.
An accumulator drops a document only when that is certain: even with the greatest
contribution of every term still to come it stays below the tenth score reached so far in
its shard. The last stage leaves ten documents for each item and shard; the final
selection ranks those.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockwell.llm.common import whole_text, written

TOP = 10
#: Shares of the documents from which on a term belongs to the next stage.
STAGE_SHARES = (0.01, 0.03, 0.1)
ITEMS_PER_BUNDLE = 512
DOCS_PER_SHARD = 8192
#: Bits of the filter that tells which terms occur in items at all.
FILTER_BITS = 1 << 23
#: Stands for a null id in the order of equal scores.
LAST_ID = 2**63 - 1
#: Terms in UTF-8: ASCII letters and digits, and all that is not ASCII.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: A worker remembers the hashes of at most so many terms.
CACHED_TERMS = 100_000


class TermKeys(dict):
    def __missing__(self, term: bytes) -> int:
        key = xxhash.xxh3_64_intdigest(term)
        if len(self) < CACHED_TERMS:
            self[term] = key
        return key


def term_counts(text: str | None, keys: TermKeys) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted distinct 64-bit keys of a whole text's terms, how often each occurs, and all occurrences."""
    terms = TERM.findall((text or "").encode("utf-8", "surrogatepass").lower())
    found = np.fromiter(map(keys.__getitem__, terms), np.uint64, len(terms))
    distinct, counts = np.unique(found, return_counts=True)
    return distinct, counts, len(terms)


@dataclass(frozen=True)
class Corpus:
    documents: int
    terms: int

    def length_part(self, n: np.ndarray) -> np.ndarray:
        """The whole number m of documents with ``n`` terms."""
        return 100 - 75 + (75 * n * self.documents) // max(self.terms, 1)

    def term_part(self, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, item_id, key, times``: the distinct terms of every item row."""

    def split(batches):
        keys = TermKeys()
        for batch in batches:
            parts = [term_counts(t.as_py(), keys)[:2] for t in batch.column(2)]
            rows = np.repeat(np.arange(batch.num_rows), [len(p[0]) for p in parts])
            own = batch.take(pa.array(rows, pa.int64()))
            found = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
            times = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [own.column(0), own.column(1), pa.array(found.view(np.int64)), pa.array(times.astype(np.int64))],
                names=["item", "item_id", "key", "times"],
            )

    numbered = items.select(
        F.monotonically_increasing_id().alias("item"), F.col(id_col).cast("long").alias("item_id"), whole_text(text_col).alias("text")
    )
    return numbered.mapInArrow(split, "item long, item_id long, key long, times long")


def _filter(terms: DataFrame) -> np.ndarray:
    """One bit for each class of keys, set if an item holds a term of it; of a fixed size."""
    place = F.pmod("key", F.lit(FILTER_BITS))
    words = (
        terms.select(place.alias("place")).distinct()
        .groupBy(F.floor(F.col("place") / 32).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(place % 32 AS INT)))").alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_BITS // 32, np.uint32)
    for row in words:
        bits[row["word"]] = row["bits"]
    return np.unpackbits(bits.view(np.uint8), bitorder="little").view(bool)


def _postings(docs: DataFrame, wanted: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """``row, ord, n, keys, counts``: of each document its length and the terms that items may hold."""
    packed = np.packbits(wanted).tobytes()

    def split(batches):
        keys = TermKeys()
        bits = np.unpackbits(np.frombuffer(packed, np.uint8)).view(bool)
        for batch in batches:
            sizes, found, counts = [], [], []
            for text in batch.column(2):
                distinct, times, n = term_counts(text.as_py(), keys)
                held = bits[(distinct % np.uint64(FILTER_BITS)).astype(np.int64)]
                sizes.append(n)
                found.append(distinct[held].tobytes())
                counts.append(times[held].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(found, pa.binary()), pa.array(counts, pa.binary())],
                names=["row", "ord", "n", "keys", "counts"],
            )

    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("ord"),
        whole_text(text_col).alias("text"),
    )
    return numbered.mapInArrow(split, "row long, ord long, n long, keys binary, counts binary").where("n > 0")


def _term_table(postings: DataFrame, corpus: Corpus) -> DataFrame:
    """``key, df, most``: documents that hold a term, and its greatest part of a score before its weight."""

    def count(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64)
            tf = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).astype(np.int64)
            held = [len(x) // 8 for x in batch.column(1).to_pylist()]
            m = np.repeat(corpus.length_part(batch.column(0).to_numpy()), held)
            distinct, place, df = np.unique(keys, return_inverse=True, return_counts=True)
            most = np.zeros(len(distinct), np.int64)
            np.maximum.at(most, place, corpus.term_part(tf, m))
            yield pa.RecordBatch.from_arrays(
                [pa.array(distinct.view(np.int64)), pa.array(df.astype(np.int64)), pa.array(most)], names=["key", "df", "most"]
            )

    partial = postings.select("n", "keys", "counts").mapInArrow(count, "key long, df long, most long")
    return partial.groupBy("key").agg(F.sum("df").alias("df"), F.max("most").alias("most"))


def _owned(postings: DataFrame, stage: int, common: np.ndarray, stages: np.ndarray, corpus: Corpus, shards: int, bundles: int) -> DataFrame:
    """``bundle, shard, row, ord, keys, parts``: the postings that a stage owns, with their parts of scores."""

    def own(batches):
        for batch in batches:
            found, parts, kept = [], [], []
            lengths = corpus.length_part(batch.column(3).to_numpy())
            for i, (held, times) in enumerate(zip(batch.column(4), batch.column(5))):
                keys = np.frombuffer(held.as_buffer(), np.uint64)
                tf = np.frombuffer(times.as_buffer(), np.uint32).astype(np.int64)
                at = np.minimum(np.searchsorted(common, keys), max(len(common) - 1, 0))
                owner = np.where(common[at] == keys, stages[at], 0) if len(common) else np.zeros(len(keys), np.int64)
                mine = owner == stage
                if mine.any():
                    kept.append(i)
                    found.append(keys[mine].tobytes())
                    parts.append(corpus.term_part(tf[mine], lengths[i]).astype(np.uint32).tobytes())
            rows = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), rows.column(2), pa.array(found, pa.binary()), pa.array(parts, pa.binary())],
                names=["shard", "row", "ord", "keys", "parts"],
            )

    dealt = postings.select(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), "row", "ord", "n", "keys", "counts")
    owned = dealt.mapInArrow(own, "shard long, row long, ord long, keys binary, parts binary")
    return owned.select(F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle"), "*")


_STATE = (
    "bundle int, shard long, item long, item_id long, keys array<long>, factors array<long>, stages array<int>,"
    " bounds array<long>, rows binary, ords binary, scores binary"
)


def _advance(stage: int, top: int):
    """The function of one stage: bundles and postings of one shard in, bundles out."""

    def advance(key: tuple[Any, ...], bundle: pd.DataFrame, posted: pd.DataFrame) -> pd.DataFrame:
        rows, ords = posted["row"].to_numpy(np.int64), posted["ord"].to_numpy(np.int64)
        held = [len(x) // 8 for x in posted["keys"]]
        keys = np.frombuffer(b"".join(posted["keys"]), np.uint64)
        parts = np.frombuffer(b"".join(posted["parts"]), np.uint32).astype(np.int64)
        place = np.repeat(np.arange(len(rows)), held)
        order = np.argsort(keys, kind="stable")
        keys, parts, place = keys[order], parts[order], place[order]
        by_row = np.argsort(rows)
        out_rows, out_ords, out_scores = [], [], []
        for own, factors, owners, bounds, old, old_ords, old_scores in zip(
            *(bundle[c] for c in ("keys", "factors", "stages", "bounds", "rows", "ords", "scores"))
        ):
            own, factors, owners = (np.asarray(x, np.int64) for x in (own, factors, owners))
            added = np.zeros(len(rows), np.int64)
            for term, factor in zip(own[owners == stage].view(np.uint64), factors[owners == stage]):
                at = slice(*np.searchsorted(keys, [term, term + np.uint64(1)]) if term != np.uint64(2**64 - 1) else (np.searchsorted(keys, term), len(keys)))
                added[place[at]] += factor * parts[at]
            carried, carried_ords, scores = (np.frombuffer(x, np.int64) for x in (old, old_ords, old_scores))
            if len(rows):
                at = by_row[np.minimum(np.searchsorted(rows, carried, sorter=by_row), len(rows) - 1)]
                met = rows[at] == carried
                scores = scores + np.where(met, added[at], 0)
                added[at[met]] = 0
            new = np.flatnonzero(added)
            carried = np.concatenate([carried, rows[new]])
            carried_ords = np.concatenate([carried_ords, ords[new]])
            scores = np.concatenate([scores, added[new]])
            if len(scores) > top:
                tenth = np.partition(scores, len(scores) - top)[len(scores) - top]
                still = int(np.asarray(bounds, np.int64)[np.asarray(owners) > stage].sum())
                hopeful = scores + still >= tenth
                carried, carried_ords, scores = carried[hopeful], carried_ords[hopeful], scores[hopeful]
            out_rows.append(carried.tobytes())
            out_ords.append(carried_ords.tobytes())
            out_scores.append(scores.tobytes())
        return bundle.assign(rows=out_rows, ords=out_ords, scores=out_scores)

    return advance


def _best_of_shards(state: DataFrame, top: int) -> DataFrame:
    """``item, item_id, ord, row, score``: the best of every item in every shard."""

    def best(batches):
        for batch in batches:
            found = []
            for item, item_id, rows, ords, scores in zip(*(batch.column(i) for i in range(5))):
                rows, ords, scores = (np.frombuffer(x.as_buffer(), np.int64) for x in (rows, ords, scores))
                for i in np.lexsort((rows, ords, -scores))[:top]:
                    found.append((item.as_py(), item_id.as_py(), ords[i], rows[i], scores[i]))
            columns = zip(*found) if found else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["item", "item_id", "ord", "row", "score"]
            )

    return state.select("item", "item_id", "rows", "ords", "scores").mapInArrow(
        best, "item long, item_id long, ord long, row long, score long"
    )


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    stage_shares: tuple[float, ...] = STAGE_SHARES,
    items_per_bundle: int = ITEMS_PER_BUNDLE,
    docs_per_shard: int = DOCS_PER_SHARD,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score above 0.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z
    lower-cased, of whole texts; a null text has none. Items without a term that a document holds
    have no row. Rows that repeat an id are documents, or items, of their own. Equal scores are
    ordered by id, null (and 2^63 - 1, which is taken for null) last, then by place in the
    input. Empty tables give no rows; other columns are not read. Terms are told apart by
    64-bit hashes.
    """
    terms = written(_item_terms(items, item_id_col, item_text_col), "item_terms")
    postings = written(_postings(docs, _filter(terms), id_col, text_col), "postings")
    totals = postings.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    corpus = Corpus(totals["n"], totals["terms"])
    table = written(_term_table(postings, corpus).join(terms.select("key").distinct(), "key", "left_semi"), "terms")

    stage = F.lit(0)
    for share in stage_shares:
        stage = stage + (F.col("df") >= share * corpus.documents).cast("int")
    # A document holds few distinct terms, so at most their mean number / share of all terms is that common.
    rows = sorted((r["key"] % 2**64, r["stage"]) for r in table.select("key", stage.alias("stage")).where("stage > 0").collect())
    common, owners = np.array([k for k, _ in rows], np.uint64), np.array([s for _, s in rows], np.int64)

    weight = F.floor(1000 * F.ln((2.0 * corpus.documents + 2.0) / (2 * F.col("df") + 1))).cast("long")
    factors = terms.join(table, "key").select(
        "item", "item_id", "key", (F.col("times") * weight).alias("factor"), stage.alias("stage"), "most"
    )
    queries = written(
        factors.groupBy("item", "item_id").agg(
            F.collect_list(F.struct("key", "factor", "stage", (F.col("factor") * F.col("most")).alias("bound"))).alias("q")
        ),
        "queries",
    )
    shards = max(1, math.ceil(corpus.documents / docs_per_shard))
    bundles = max(1, math.ceil(queries.count() / items_per_bundle))
    nothing = F.lit(b"")
    state = queries.select(
        F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int").alias("bundle"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        "item",
        "item_id",
        F.col("q.key").alias("keys"),
        F.col("q.factor").alias("factors"),
        F.col("q.stage").alias("stages"),
        F.col("q.bound").alias("bounds"),
        nothing.alias("rows"),
        nothing.alias("ords"),
        nothing.alias("scores"),
    )
    for number in range(len(stage_shares) + 1):
        owned = _owned(postings, number, common, owners, corpus, shards, bundles)
        state = (
            state.groupBy("bundle", "shard")
            .cogroup(owned.groupBy("bundle", "shard"))
            .applyInPandas(_advance(number, top), _STATE)
        )
    best = _best_of_shards(state, top)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "ord", "row"))
    ranked = best.where("score > 0").withColumn("rank", rank).where(F.col("rank") <= top)
    doc_id = F.when(F.col("ord") != LAST_ID, F.col("ord"))
    return ranked.select("item_id", "rank", doc_id.alias("doc_id"), "score")
