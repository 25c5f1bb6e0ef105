"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are hashed character n-grams of one to three letters of the lower-cased
whole text, weighted by TF-IDF. Document frequencies are counted over all
labelled training rows in Spark. Weights are fitted with follow-the-regularised-
leader (FTRL-Proximal) under L1 and L2 penalties on a bounded sample, and the
scores are calibrated by one temperature on sampled rows that the fit did not see.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockwell.llm.common import map_rows, whole_text

#: Buckets of hashed n-grams.
BUCKETS = 1 << 16
ORDERS = 3
#: Labelled rows that the weights are fitted on, spread evenly over the languages.
SAMPLE_ROWS = 2_000
#: More languages than this are refused: the model holds a weight for each and bucket.
MAX_LANGUAGES = 64
UNKNOWN = "und"
#: Characters handled at a time.
_CHUNK = 1 << 18


@dataclass
class LanguageModel:
    languages: list[str]
    #: Weight times inverse document frequency, by bucket and language.
    values: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0


def ngram_buckets(codes: np.ndarray) -> list[np.ndarray]:
    """For each order the bucket of the n-gram that starts at each code point."""
    padded = np.concatenate([codes, np.zeros(ORDERS - 1, codes.dtype)]).astype(np.uint32)
    h = np.full(len(codes), 0x9E3779B9, np.uint32)
    found = []
    for order in range(ORDERS):
        h = (h ^ padded[order : order + len(codes)]) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        found.append((h * np.uint32(0xC2B2AE35)) >> np.uint32(16))
    return found


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _chunks(texts: list[str]):
    """(numbers of texts, their starts, code points): texts joined by zeros, long ones in parts.

    A part carries the first letters of the next one, so no n-gram is lost or counted twice.
    """
    numbers, starts, ends, parts, length = [], [], [], [], 0
    gap = np.zeros(ORDERS - 1, np.uint32)
    for number, text in enumerate(texts):
        codes = code_points(text)
        for at in range(0, len(codes), _CHUNK):
            part = codes[at : at + _CHUNK + ORDERS - 1]
            own = min(_CHUNK, len(codes) - at)
            numbers.append(number)
            starts.append(length)
            ends.append(length + own)
            parts += [part, gap]
            length += len(part) + len(gap)
            if length >= _CHUNK:
                yield np.array(numbers), np.array(starts), np.array(ends), np.concatenate(parts)
                numbers, starts, ends, parts, length = [], [], [], [], 0
    if numbers:
        yield np.array(numbers), np.array(starts), np.array(ends), np.concatenate(parts)


def logits(texts: list[str], model: LanguageModel) -> np.ndarray:
    """Scores of whole texts before calibration; rows of texts without letters are undefined."""
    sums = np.zeros((len(texts), len(model.languages)))
    totals = np.zeros(len(texts))
    for numbers, starts, ends, codes in _chunks(texts):
        by_position = sum(model.values[g] for g in ngram_buckets(codes))
        running = np.concatenate([np.zeros((1, by_position.shape[1])), np.cumsum(by_position, axis=0, dtype=np.float64)])
        np.add.at(sums, numbers, running[ends] - running[starts])
        np.add.at(totals, numbers, ORDERS * (ends - starts))
    return sums / np.maximum(totals, 1)[:, None] + model.bias


def probabilities(scores: np.ndarray, temperature: float) -> np.ndarray:
    scaled = scores / temperature
    grown = np.exp(scaled - scaled.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the row is kept from training: a quarter of all ids; never for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def document_frequencies(training: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each bucket, and all documents, over every row of ``training``."""

    def count(batches):
        frequency, rows = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                rows += 1
                present = np.zeros(BUCKETS, bool)
                codes = code_points(text)
                for at in range(0, len(codes), _CHUNK):
                    part = codes[at : at + _CHUNK + ORDERS - 1]
                    for found in ngram_buckets(part):
                        present[found[:_CHUNK]] = True
                frequency += present
        used = np.flatnonzero(frequency)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*used, -1], pa.int32()), pa.array([*frequency[used], rows], pa.int64())],
            names=["bucket", "n"],
        )

    counted = training.select("text").mapInArrow(count, "bucket int, n long")
    # One row for each bucket at most.
    sums = counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    frequency = np.zeros(BUCKETS)
    for row in sums:
        if row["bucket"] >= 0:
            frequency[row["bucket"]] = row["n"]
    return frequency, sum(r["n"] for r in sums if r["bucket"] < 0)


def _sampled(training: DataFrame, counts: dict[str, int], rows: int) -> DataFrame:
    """At most ``rows`` training rows, an equal number of each language by smallest hash."""
    each = max(1, rows // max(1, len(counts)))
    place = F.xxhash64("doc_id", F.lit("sample"))
    unit = (F.shiftrightunsigned(place, 11) / float(1 << 53)).alias("unit")
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 3.0 * each / n + 0.01))])
    near = training.withColumn("place", place).where(unit < F.element_at(share, F.col("lang")))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id", "text"))
    return near.withColumn("nth", first).where(F.col("nth") <= each)


def _sample_features(sample: DataFrame):
    def features(batches):
        for batch in batches:
            buckets, shares = [], []
            for text in batch.column(1).to_pylist():
                counts = np.zeros(BUCKETS, np.float32)
                codes = code_points(text)
                for at in range(0, len(codes), _CHUNK):
                    for found in ngram_buckets(codes[at : at + _CHUNK + ORDERS - 1]):
                        np.add.at(counts, found[:_CHUNK], 1)
                used = np.flatnonzero(counts)
                buckets.append(used.astype(np.int32))
                shares.append(counts[used] / max(1, ORDERS * len(codes)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(buckets, pa.list_(pa.int32())),
                    pa.array(shares, pa.list_(pa.float32())),
                    batch.column(2),
                ],
                names=["lang", "buckets", "shares", "nth"],
            )

    # Bounded by SAMPLE_ROWS rows of at most BUCKETS entries.
    return (
        sample.select("lang", "text", "nth")
        .mapInArrow(features, "lang string, buckets array<int>, shares array<float>, nth int")
        .toArrow()
    )


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    classes: int,
    epochs: int = 6,
    rate: float = 2.0,
    beta: float = 1.0,
    l1: float = 0.002,
    l2: float = 0.0005,
    seed: int = 7,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights by bucket and class, and biases, of FTRL-Proximal with elastic net.

    A weight stays exactly zero until its accumulated gradient passes ``l1``.
    """
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(at):
        own = z[at]
        shrunk = np.sign(own) * np.maximum(np.abs(own) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / rate + l2)

    order = np.random.RandomState(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, label = rows[i]
            w = weights(at)
            score = x @ w
            p = np.exp(score - score.max())
            p /= p.sum()
            p[label] -= 1
            gradient = x[:, None] * p[None, :]
            grown = n[at] + gradient**2
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(n[at])) / rate * w
            n[at] = grown
    all_weights = weights(slice(None))
    return all_weights[:-1], all_weights[-1]


def fitted_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t):
        p = probabilities(scores, math.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, golden = -4.0, 4.0, (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return math.exp((low + high) / 2)


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Fit on text and language of labelled rows that are not held out.

    Without any such row the model knows no language and calls every text unknown.
    """
    training = docs.select("doc_id", F.col("text").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    counts = {r["lang"]: r["n"] for r in training.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    frequency, documents = document_frequencies(training)
    idf = np.log((1 + documents) / (1 + frequency)) + 1
    table = _sample_features(_sampled(training, counts, sample_rows))
    number = {language: i for i, language in enumerate(languages)}
    fit, calibrate = [], []
    order = np.lexsort((table["lang"].to_numpy(zero_copy_only=False).astype(str), table["nth"].to_numpy()))
    for i in order.tolist():
        at = table["buckets"][i].values.to_numpy()
        x = table["shares"][i].values.to_numpy() * idf[at]
        row = (np.append(at, BUCKETS), np.append(x, 1.0), number[table["lang"][i].as_py()])
        (calibrate if table["nth"][i].as_py() % 5 == 0 else fit).append(row)
    weights, bias = ftrl(fit, len(languages))
    scores = np.array([x[:-1] @ weights[at[:-1]] + bias for at, x, _ in calibrate]).reshape(-1, len(languages))
    temperature = fitted_temperature(scores, np.array([label for *_, label in calibrate], int))
    return LanguageModel(languages, (weights * idf[:, None]).astype(np.float32), bias, temperature)


def predictions(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """Language and calibrated probability; unknown with 0 for texts without a letter."""
    known = [i for i, t in enumerate(texts) if t and model.languages and has_letter(t)]
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if known:
        p = probabilities(logits([texts[i] for i in known], model), model.temperature)
        for i, best, score in zip(known, p.argmax(axis=1), p.max(axis=1)):
            names[i], scores[i] = model.languages[best], score
    return names, scores


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, lang_pred, score``.

    Only the text is read for a prediction. Null, empty and letterless texts are
    ``und`` with score 0. Repeated rows are predicted alike; an empty table
    gives no rows; other columns are not read.
    """

    def apply(batches):
        for batch in batches:
            names, scores = predictions(batch.column(2).to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), whole_text(text_col).alias("text"))
    return source.mapInArrow(apply, "doc_id long, held_out boolean, lang_pred string, score double")


def identify_languages(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    return predict(docs, train(docs, sample_rows))


def keep_identified(docs: DataFrame, model: LanguageModel, least: float, text_col: str = "text") -> DataFrame:
    """Rows whose language is known with at least that probability, with all their columns.

    Null, empty and letterless texts go; rows are judged one by one, so repeats are judged
    alike. An empty table gives no rows. Columns may have any name.
    """
    place = docs.columns.index(text_col)

    def keep(batches):
        for batch in batches:
            names, scores = predictions(batch.column(place).to_pylist(), model)
            kept = [n != UNKNOWN and s >= least for n, s in zip(names, scores)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return map_rows(docs, keep)
