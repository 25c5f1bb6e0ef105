"""Documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept; its result is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from stockwell.llm import exact_dedup, language_id, mixing, near_dedup, packing
from stockwell.llm.common import table, written

#: Documents whose best language is less probable than this are rejected.
LEAST_LANGUAGE_SCORE = 0.3
#: Near duplicates: words of a shingle and percent of the union that must be shared.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
#: Bytes after which a batch of rows goes to a Python worker. Spark's own 10,000 rows are some
#: 25 MB of texts, held several times over on both sides by each task, and workers keep what they once took.
BATCH_BYTES = 2 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def _in_small_batches(stage):
    """``stage`` in a session that sends small batches to Python; the setting stays, for the result is computed later."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run_stage


@_in_small_batches
def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without a letter go."""
    return language_id.keep_identified(docs, language_id.train(docs), LEAST_LANGUAGE_SCORE)


@_in_small_batches
def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.drop_exact_duplicates(docs)


@_in_small_batches
def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.drop_near_duplicates(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


@_in_small_batches
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.apply_mix(docs)


@_in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences of 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identified),
    ("exact_dedup", unique),
    ("near_dedup", distinct),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = spark.conf.get(_BATCH_SETTING)
    try:
        for name, stage in STAGES:
            docs = written(stage(spark, docs, sf_dir), name)
    finally:
        spark.conf.set(_BATCH_SETTING, before)
    return docs


#: The language model and the tokenizer have no SQL form.
ORACLE_SQL = None
