"""Toxicity scores from a counterfactual-regularised linear classifier.

A word is its own hashed form and its first letters, and its score is the sum of their
weights. A text's score adds its highest-scoring words to a bias, because a few words make
a text toxic however long it is. Features are scaled by their log ratio between toxic and
other texts, counted in Spark over every labelled row; weights are fitted with
follow-the-regularised-leader under an elastic net on a bounded sample, with the bias
moved back to the share of toxic rows.

For counterfactual fairness every sampled text that names an identity is paired with
itself, each identity term swapped for another one of its kind. The squared change of the
score is part of the loss, so a term cannot carry weight only because it is often named
in toxic texts, and neutral mentions of a group stay below the threshold.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockwell.llm.common import built_side, quoted, whole_text

#: Buckets of hashed features.
BUCKETS = 1 << 18
#: Lengths of the word beginnings that are features.
BEGINNINGS = (3, 4, 5)
#: Words whose scores a text's score adds up.
POOLED = 8
#: Labelled rows that the weights are fitted on, as many toxic as other ones.
SAMPLE_ROWS = 4_000
#: Scores from here on are predicted toxic.
THRESHOLD = 0.3
WORDS = re.compile(r"[^\W_]+")
#: A worker remembers the scores of at most so many words.
CACHED_WORDS = 100_000

# Identity terms by kind: fixed values, any of which may stand for another of its line.
IDENTITIES = (
    ("women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("woman", "man", "girl", "boy", "frau", "mann", "femme", "homme", "mujer", "hombre"),
    ("female", "male", "weiblich", "männlich", "féminin", "masculin", "femenino", "masculino"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"),
    ("muslime", "christen", "juden", "musulmans", "chrétiens", "juifs", "musulmanes", "cristianos", "judíos"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indian"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual", "homosexual", "transgender", "cisgender"),
    ("old", "young", "elderly", "teenage"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens", "locals"),
    ("deaf", "blind", "disabled", "autistic"),
)


@dataclass
class ToxicityModel:
    #: Weight of a feature's presence in a word, by bucket.
    weights: np.ndarray
    bias: float


def words_of(text: str | None) -> set[str]:
    return set(WORDS.findall((text or "").lower()))


def features_of(word: str) -> list[int]:
    """Buckets of a word: the whole of it, then its beginnings."""
    parts = [f"={word}"] + [word[:n] for n in BEGINNINGS if len(word) > n]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]


class WordScores(dict):
    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        score = float(self.weights[features_of(word)].sum())
        if len(self) < CACHED_WORDS:
            self[word] = score
        return score


def pooled(scores, count: int = POOLED) -> float:
    """The sum of the highest positive scores and the lowest negative ones, so many of each."""
    ordered = np.sort(np.fromiter(scores, np.float64))
    return float(np.maximum(ordered[-count:], 0).sum() + np.minimum(ordered[:count], 0).sum())


def logistic(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the row is kept from training: a quarter of all ids; never for a null id."""
    return F.coalesce(F.crc32(F.col(quoted(id_col)).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``doc_id, text, toxic`` of the labelled rows that are not held out; the highest of an id's labels counts."""
    known = (
        labels.where(F.col(quoted(label_col)).isNotNull() & F.col(quoted(id_col)).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(quoted(id_col)).cast("long").alias("doc_id"))
        .agg((F.max(quoted(label_col)).cast("int") >= 1).cast("int").alias("toxic"))
    )
    texts = docs.where(~held_out(id_col)).select(F.col(quoted(id_col)).cast("long").alias("doc_id"), whole_text(quoted(text_col)).alias("text"))
    return texts.join(built_side(known), "doc_id")


def feature_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(texts that hold each bucket, all texts) by label, over every row."""

    def count(batches):
        held, texts = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {f for word in words_of(text) for f in features_of(word)}
                held[label][list(found)] += 1
                texts[label] += 1
        used = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*used, -1], pa.int32()),
                pa.array([*held[0][used], texts[0]], pa.int64()),
                pa.array([*held[1][used], texts[1]], pa.int64()),
            ],
            names=["bucket", "clean", "toxic"],
        )

    partial = rows.select("text", "toxic").mapInArrow(count, "bucket int, clean long, toxic long")
    held, texts = np.zeros((2, BUCKETS)), np.zeros(2)
    # One row for each bucket at most.
    for row in partial.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).collect():
        if row["bucket"] < 0:
            texts += [row["clean"], row["toxic"]]
        else:
            held[:, row["bucket"]] = row["clean"], row["toxic"]
    return held, texts


def sampled(rows: DataFrame, texts: np.ndarray, count: int = SAMPLE_ROWS) -> list[tuple[set[str], int]]:
    """Words and labels of at most ``count`` rows, half of each label, by smallest hash of the id."""
    each = max(1, count // 2)
    place = F.xxhash64("doc_id", F.lit("toxicity"))
    # A first cut well above what is needed keeps the sort below small; its rows are exact all the same.
    unit = F.shiftrightunsigned(place, 11) / float(1 << 53)
    share = F.when(F.col("toxic") == 1, min(1.0, 3 * each / max(texts[1], 1))).otherwise(min(1.0, 3 * each / max(texts[0], 1)))
    near = rows.where(unit <= share).withColumn("place", place)
    nth = F.row_number().over(Window.partitionBy("toxic").orderBy("place", "doc_id", F.xxhash64("text")))

    def split(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([sorted(words_of(t.as_py())) for t in batch.column(2)], pa.list_(pa.string()))],
                names=["toxic", "nth", "words"],
            )

    chosen = near.withColumn("nth", nth).where(F.col("nth") <= each)
    found = chosen.select("toxic", "nth", "text").mapInArrow(split, "toxic int, nth int, words array<string>").collect()
    return [(set(r["words"]), r["toxic"]) for r in sorted(found, key=lambda r: (r["nth"], r["toxic"]))]


def swapped(words: set[str], turn: int, identities=IDENTITIES) -> set[str] | None:
    """The words with each identity term replaced by another of its kind; None if there is none."""
    changed = set()
    for word in words:
        kind = next((k for k in identities if word in k), None)
        changed.add(kind[(kind.index(word) + 1 + turn % (len(kind) - 1)) % len(kind)] if kind else word)
    return None if changed == words else changed


def _ratios(held: np.ndarray, texts: np.ndarray, least: int = 3) -> np.ndarray:
    """Log ratio of each bucket's share in toxic and in other texts; 0 for buckets in fewer than ``least``."""
    share = (held + 0.5) / (texts[:, None] + 1)
    ratio = np.log(share[1] / share[0])
    return np.where(held.sum(axis=0) >= least, ratio, 0.0)


def fit(
    rows: list[tuple[set[str], int]],
    ratios: np.ndarray,
    prior: float,
    identities=IDENTITIES,
    swap_penalty: float = 4.0,
    epochs: int = 4,
    rate: float = 0.1,
    l1: float = 0.02,
    l2: float = 0.01,
    seed: int = 11,
) -> ToxicityModel:
    """FTRL-Proximal weights of the scaled features, in changing order over the rows.

    ``swap_penalty`` weighs the squared change of a text's score under swapped identities.
    """
    # The bias is the last feature but one; the last one pads short words and has no scale.
    z, n = np.zeros(BUCKETS + 2), np.zeros(BUCKETS + 2)
    scale = np.concatenate([ratios, [1.0, 0.0]])
    width, cache = 1 + len(BEGINNINGS), {}

    def buckets(word):
        if word not in cache:
            own = [f for f in features_of(word) if ratios[f]]
            cache[word] = own + [BUCKETS + 1] * (width - len(own))
        return cache[word]

    def table(words):
        found = (buckets(w) for w in sorted(words))
        return np.array([f for f in found if f[0] <= BUCKETS], np.int64).reshape(-1, width)

    def weights(at):
        own = z[at]
        return -np.sign(own) * np.maximum(np.abs(own) - l1, 0) / ((1 + np.sqrt(n[at])) / rate + l2)

    def features(at):
        """Buckets and counts of the words that are pooled at the present weights."""
        if len(at):
            # Before a feature has been met its ratio ranks its words.
            w = (np.where(n[at] > 0, weights(at), 0.01) * scale[at]).sum(axis=1)
            order = np.argsort(w, kind="stable")
            high, low = order[-POOLED:], order[:POOLED]
            at = at[np.union1d(high[w[high] > 0], low[w[low] < 0])]
        used, count = np.unique(np.append(at.ravel(), BUCKETS), return_counts=True)
        return used, count * scale[used]

    tables = [table(words) for words, _ in rows]
    order = np.random.RandomState(seed)
    for epoch in range(epochs):
        for i in order.permutation(len(rows)):
            words, label = rows[i]
            at, x = features(tables[i])
            w = weights(at)
            gradient = (logistic(float(w @ x)) - label) * x
            other = swapped(words, epoch, identities) if swap_penalty else None
            if other is not None:
                at_other, x_other = features(table(other))
                both = np.union1d(at, at_other)
                change, grown = np.zeros(len(both)), np.zeros(len(both))
                change[np.searchsorted(both, at)] += x
                change[np.searchsorted(both, at_other)] -= x_other
                grown[np.searchsorted(both, at)] = gradient
                w = weights(both)
                gradient, at = grown + swap_penalty * float(w @ change) * change, both
            more = n[at] + gradient**2
            z[at] += gradient - (np.sqrt(more) - np.sqrt(n[at])) / rate * w
            n[at] = more
    final = weights(slice(None))
    toxic = sum(label for _, label in rows)
    share = min(max(toxic / max(len(rows), 1), 1e-6), 1 - 1e-6)
    bias = final[BUCKETS] + math.log(prior / (1 - prior)) - math.log(share / (1 - share))
    return ToxicityModel((final[:BUCKETS] * ratios).astype(np.float32), float(bias))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    identities=IDENTITIES,
    swap_penalty: float = 4.0,
) -> ToxicityModel:
    """Fit on text and label of labelled rows that are not held out.

    Where only one label, or none, is known, every text scores the smoothed share of toxic rows.
    """
    rows = labelled(docs, labels, id_col, text_col, label_col)
    held, texts = feature_counts(rows)
    prior = (texts[1] + 0.5) / (texts.sum() + 1) if texts.sum() else 1e-6
    if not texts.all():
        return ToxicityModel(np.zeros(BUCKETS, np.float32), math.log(prior / (1 - prior)))
    return fit(sampled(rows, texts, sample_rows), _ratios(held, texts), prior, identities, swap_penalty)


def score_texts(texts: list[str | None], model: ToxicityModel, words: WordScores | None = None) -> list[float]:
    words = WordScores(model.weights) if words is None else words
    return [logistic(model.bias + pooled(words[w] for w in words_of(t))) for t in texts]


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    Only the whole text is read for a score. Null, empty and wordless texts score the share of
    toxic rows that the model was fitted with. Repeated rows score alike; an empty table
    gives no rows; other columns are not read.
    """

    def apply(batches):
        words = WordScores(model.weights)
        for batch in batches:
            scores = np.array(score_texts(batch.column(2).to_pylist(), model, words), np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    source = docs.select(
        F.col(quoted(id_col)).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), whole_text(quoted(text_col)).alias("text")
    )
    return source.mapInArrow(apply, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return score(docs, train(docs, labels, **options))
