"""Ranked search, toxicity and vector codes on awkward rows, against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from checks.compare import _rows, oracle_rows
from stockwell.llm import lexical, oracles, queries, toxicity, vector_codes

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_ranked_search", "op13_vector_codes"])
def test_equals_sql(spark, name):
    df = queries.llm_queries()[name](spark, SMALL)
    columns, found = oracle_rows(SMALL, oracles.llm_oracles()[name])
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(columns, found)


# Ranked search --------------------------------------------------------------


def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _search_brute(docs, items):
    counted = [(i, Counter(_terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for item, text in items:
        scored = []
        for i, c in counted:
            m = 100 - 75 + 75 * sum(c.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in _terms(text) if t in c
            )
            if score > 0:
                scored.append((i is None, i, score))
        scored.sort(key=lambda s: (-s[2], s[0], s[1] or 0))
        found += [(item, rank, i, score) for rank, (_, i, score) in enumerate(scored[:10], 1)]
    return sorted(found, key=repr)


def test_search_of_awkward_rows_in_many_shards_and_bundles(spark):
    rng = np.random.RandomState(2)
    docs = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.4, rng.randint(1, 40)) if x < 200)) for i in range(600)]
    docs += [(i, "Tie tie, TIE! é日本 a_b 7") for i in (700, 701, 701, None)]
    docs += [(800, None), (801, ""), (802, "?! --"), (803, "w1 " * 50_000 + "rare")]
    items = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.4, 12))) for i in range(20)]
    items += [(50, "tie"), (50, "É日本 é日本 rare"), (51, None), (52, ""), (53, "absent"), (None, "W1 7")]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, rank string, row int").repartition(5)
    queries_ = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, doc_id string")
    found = lexical.search(df, queries_, docs_per_shard=100, items_per_bundle=7)
    assert sorted(map(tuple, found.collect()), key=repr) == _search_brute(docs, items)
    assert lexical.search(df.limit(0), queries_).count() == 0
    assert lexical.search(df, queries_.limit(0)).count() == 0


def test_accumulators_drop_only_what_cannot_win(spark):
    # Every document holds the common term; those with the rare one win only in some of the items.
    docs = [(i, "common " + "filler " * (i % 50) + ("rare" if i % 97 == 0 else "")) for i in range(1000)]
    items = [(1, "common rare"), (2, "common"), (3, "rare rare common common filler")]
    found = lexical.search(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), docs_per_shard=300
    )
    assert sorted(map(tuple, found.collect()), key=repr) == _search_brute(docs, items)


# Vector codes ---------------------------------------------------------------


def test_orchard_search_finds_the_lowest_nearest_entry():
    rng = np.random.RandomState(4)
    for size, width, spread in ((1, 3, 5), (40, 4, 3), (256, 16, 900), (256, 2, 4)):
        entries = rng.randint(-spread, spread + 1, (size, width))
        asked = rng.randint(-spread, spread + 1, (500, width))
        found, distance = vector_codes.Codebook(entries).nearest(asked)
        all_pairs = vector_codes.squared(asked[:, None, :], entries[None, :, :])
        assert (found == all_pairs.argmin(axis=1)).all() and (distance == all_pairs.min(axis=1)).all()


def _codes_brute(rows, entries):
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // 4
    books = [[v[p * width : (p + 1) * width] for _, v, _ in kept[:entries]] for p in range(4)]

    def nearest(p, v):
        own = v[p * width : (p + 1) * width]
        return min((sum((a - b) ** 2 for a, b in zip(own, e)), k) for k, e in enumerate(books[p]))

    for _ in range(4):
        assigned = [[nearest(p, v)[1] for _, v, _ in kept] for p in range(4)]
        for p in range(4):
            for k in range(len(books[p])):
                own = [v[p * width : (p + 1) * width] for (_, v, _), at in zip(kept, assigned[p]) if at == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded, by_label = [], Counter()
    for i, v, label in kept:
        best = [nearest(p, v) for p in range(4)]
        coded.append((i, label, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
        by_label[label] += coded[-1][3]
    return sorted(((i, c, e, by_label[label], sha) for i, label, c, e in coded), key=repr)


def test_vector_codes_of_awkward_rows(spark):
    rng = np.random.RandomState(9)
    given = [(i, rng.randn(8).round(2).tolist(), i % 3 or None) for i in range(80)]
    given += [(3, given[3][1], 1), (None, given[5][1], 2), (90, [0.0] * 8, 2), (91, [-1.0, 1e-9, -1e-9] + [0.5] * 5, 7)]
    unusable = [(100, None, 1), (101, [None] + [1.0] * 7, 1), (102, [float("nan")] * 8, 1), (103, [float("-inf")] * 8, 1)]
    schema = "vec_id long, embedding array<double>, label int, code string, whole int"
    df = spark.createDataFrame([(*g, "x", 1) for g in given + unusable], schema).repartition(4)
    for entries in (16, 256):
        found = vector_codes.vector_codes(df, entries=entries).collect()
        assert sorted(map(tuple, found), key=repr) == _codes_brute(given, entries)
    other = spark.createDataFrame([(1, [1.0] * 8, 1), (2, [1.0] * 4, 1), (3, [], 1), (4, [1e300] * 8, 1)], "vec_id long, embedding array<double>, label int")
    rows = {r.vec_id: r for r in vector_codes.vector_codes(other).collect()}
    assert [rows[i].code for i in (1, 2, 3, 4)] == ["00000000", None, None, "01010101"]
    assert vector_codes.vector_codes(df.limit(0)).count() == 0


# Toxicity -------------------------------------------------------------------


def test_toxicity_finds_held_out_toxic_texts(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in queries.op12_toxicity(spark, sf_dir).collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    known = [(rows[r.doc_id], r.toxic) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if rows[r.doc_id].held_out]
    toxic = [r.predicted for r, label in known if label]
    clean = [r.predicted for r, label in known if not label]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.02 * len(clean)


def _rows_that_name_a_group():
    rng = np.random.RandomState(0)
    rows = []
    for i in range(600):
        words = {f"word{k}" for k in rng.randint(0, 300, 12)}
        if i % 2 and rng.rand() < 0.7:
            words.add(("idiot", "scum", "trash")[rng.randint(3)])
        if rng.rand() < (0.8 if i % 2 else 0.03):
            words.add("muslims")
        rows.append((words, i % 2))
    held, texts = np.zeros((2, toxicity.BUCKETS)), np.zeros(2)
    for words, label in rows:
        held[label][list({f for w in words for f in toxicity.features_of(w)})] += 1
        texts[label] += 1
    return rows, toxicity._ratios(held, texts)


def test_swapped_identities_keep_neutral_mentions_clean():
    rows, ratios = _rows_that_name_a_group()
    plain, fair = (toxicity.fit(rows, ratios, 0.5, swap_penalty=p) for p in (0.0, 4.0))
    mention = [f"the {g} word1 word2 met here" for g in ("muslims", "christians", "jews")]
    biased, even = toxicity.score_texts(mention, plain), toxicity.score_texts(mention, fair)
    assert biased[0] > 0.8 and biased[0] - biased[1] > 0.5
    assert max(even) < 0.35 and max(even) - min(even) < 0.05
    assert toxicity.score_texts(["you idiot scum"], fair)[0] > 0.9
    assert toxicity.swapped({"women", "x"}, 0) == {"men", "x"} and toxicity.swapped({"x"}, 0) is None


def test_toxicity_of_awkward_rows(spark):
    docs = [(i, t, "x", 1) for i, t in enumerate(["you idiot", "a nice day", "scum idiot", "good words"] * 30)]
    docs += [(500, None, "x", 1), (501, "", "x", 1), (501, "", "x", 1), (None, "idiot scum", "x", 1), (502, "--- !!", "x", 1), (503, "idiot " + "fine " * 200_000, "x", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, toxic string, score int").repartition(3)
    labels = [(i, 1 - i % 2) for i in range(120)] + [(0, None), (None, 1), (4, 0)]
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = toxicity.toxicity(df, given).collect()
    assert len(rows) == len(docs)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[500].score == by_id[501].score == by_id[502].score and by_id[None].held_out is False
    assert by_id[2].predicted == by_id[None].predicted == by_id[503].predicted == 1 and by_id[3].score < by_id[2].score
    for none in (given.limit(0), given.where("toxic = 0")):
        assert {r.predicted for r in toxicity.toxicity(df, none).collect()} == {0}
    assert toxicity.toxicity(df.limit(0), given).count() == 0
