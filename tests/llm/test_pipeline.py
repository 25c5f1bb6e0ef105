"""The corpus pipeline over a small table with planted copies, stage by stage against plain Python."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stockwell.llm import language_id, mixing
from test_operators import _components_brute

SMALL = "/root/testdata/sf0.001"


def _planted(spark):
    """The smallest table, and copies: exact, with white space changed, near, unrelated, and texts without letters."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rng = random.Random(6)
    long = [r for r in rows if len((r[1] or "").split()) > 120][:10]
    planted = []
    for k, (_, text, lang, source, n) in enumerate(long):
        words = text.split()
        near = list(words)
        near[rng.randrange(10, len(words) - 10)] = f"changed{k}"
        other = rng.sample(words, len(words))
        for offset, body in ((1000, text), (2000, re.sub(r"\s+", "\t", text)), (3000, " ".join(near)), (4000, " ".join(other))):
            planted.append((offset + k, body, lang, source, len(body)))
    planted += [(5000, None, "en", "a", 0), (5001, "", None, None, 0), (5002, "123 456", "en", "a", 7)]
    return rows, planted


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Documents in, and what each stage leaves, as lists of rows."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows, planted = _planted(spark)
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    spark.createDataFrame(rows + planted, schema).repartition(4).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {"documents": docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        left = stage(spark, docs, folder)
        assert number == len(corpus_pipeline.STAGES) - 1 or left.columns == schema.names
        left.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found[name] = docs.collect()
    return found


def test_language_stage_drops_only_what_has_no_language(spark, stages):
    left = {r.doc_id for r in stages["language_id"]}
    gone = {r.doc_id: r.text for r in stages["documents"] if r.doc_id not in left}
    assert {5000, 5001, 5002} <= set(gone)
    docs = spark.createDataFrame(stages["documents"])
    model = language_id.train(docs)
    least = corpus_pipeline.LEAST_LANGUAGE_SCORE
    scored = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert left == {i for i, r in scored.items() if r.lang_pred != "und" and r.score >= least}
    assert len(gone) <= 3 + 0.02 * len(stages["documents"])


def test_copies_go_and_clean_documents_stay(stages):
    before = {r.doc_id: re.sub(r"[\x20\x09-\x0D]+", " ", r.text) for r in stages["language_id"]}
    first = {}
    for i in sorted(before):
        first.setdefault(before[i], i)
    assert {r.doc_id for r in stages["exact_dedup"]} == set(first.values())

    given = [(r.doc_id, r.text) for r in stages["exact_dedup"]]
    component = _components_brute(given, corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILAR_PERCENT)
    left = {r.doc_id for r in stages["near_dedup"]}
    assert left == {i for i, (_, c) in component.items() if c == i}
    assert all(1000 + k not in left and 2000 + k not in left and 3000 + k not in left for k in range(10))
    assert all(4000 + k in left for k in range(10))


def test_mix_and_packing_keep_every_word(spark, stages):
    taken = Counter(r.doc_id for r in stages["mixing"])
    mixed = mixing.mix(spark.createDataFrame(stages["near_dedup"])).collect()
    assert taken == Counter({r.doc_id: r.taken // r.size for r in mixed if r.size and r.taken})
    pieces, fills = Counter(), {}
    for r in stages["packing"]:
        pieces[r.doc_id] += r.length
        fills.setdefault(r.sequence_id, []).append((r.offset, r.length))
    tokens = {r.doc_id: r.doc_tokens for r in stages["packing"]}
    assert pieces == Counter({i: tokens[i] * n for i, n in taken.items()})
    for spans in fills.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024


def test_an_empty_table_goes_through(spark, tmp_path):
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_send_texts_to_python_in_small_batches(spark, tmp_path):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    none = spark.read.parquet(f"{tmp_path}/documents.parquet")
    texts = spark.range(6000, numPartitions=1).select(F.repeat(F.lit("word "), 400).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["bytes", "n"])

    before = spark.conf.get(setting)
    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.unset(setting)
            stage(spark, none, str(tmp_path))
            seen = texts.mapInArrow(sizes, "bytes long, n long").agg(F.max("bytes").alias("most"), F.sum("n").alias("n")).first()
            assert seen.most < 3 << 20, name
            assert seen.n == 6000
        spark.conf.set(setting, "5m")
        corpus_pipeline.run(spark, str(tmp_path))
        assert spark.conf.get(setting) == "5m"
    finally:
        spark.conf.set(setting, before)
