"""Every operator on awkward rows, against plain Python."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from stockwell.llm import (
    chat,
    embedding_dedup,
    exact_dedup,
    language_id,
    licenses,
    mixing,
    near_dedup,
    packing,
    queries,
    secrets,
    setsketch,
    urls,
)
from stockwell.llm.common import tokenizer_file
from stockwell.llm.tournament import first_fit_decreasing

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, kept string, id long, place string, n long"
_words = random.Random(3)
BASE = " ".join(_words.choice("abcdefgh") + str(_words.randint(0, 400)) for _ in range(300))
NEAR = BASE.replace(BASE.split()[100], "changed", 1)
LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
ROWS = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n", None, "a"), (4, "One", "en", None),
    (5, "two  words", "en", "b"), (6, "two\twords", "de", "b"), (6, "two\twords", "de", "b"), (None, "two words", None, "b"),
    (7, BASE, "en", "a"), (8, NEAR, "en", "a"), (9, BASE.upper(), "en", "c"), (10, LONG, "fr", "c"),
    (11, "MIT License, mit license. SPDX-License-Identifier: Apache-2.0", "en", "a"),
    (12, 'é😀 password = "abcdefgh1" token: secret: abcdefghijk AKIAABCDEFGHIJKL12 ' + "0af" * 12, "en", "a"),
    (13, "%%% 123", None, "é"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, "x", 1, "y", 2) for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def _by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_exact_dedup(docs):
    rows = exact_dedup.exact_duplicates(docs).collect()
    groups = {}
    for i, text, *_ in ROWS:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    assert len(rows) == len(ROWS)
    for r in rows:
        group = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert r.group_size == len(group)
        assert r.keep_id == min(i for i in group if i is not None)
    assert sum(r.kept for r in rows) == len(groups)
    assert exact_dedup.drop_exact_duplicates(docs).count() == len(groups)
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0


def test_heavy_and_ordinary_digests_agree(docs):
    heavy = exact_dedup.exact_duplicates(docs, heavy_share=0.01).collect()
    ordinary = exact_dedup.exact_duplicates(docs, heavy_share=0.9).collect()
    assert sorted(map(tuple, heavy), key=repr) == sorted(map(tuple, ordinary), key=repr)


def test_near_dedup(docs):
    rows = near_dedup.near_duplicates(docs, 3, 85).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[1].n_shingles, by_id[3].n_shingles, by_id[4].n_shingles, by_id[10].n_shingles) == (0, 0, 1, 59_998)
    assert [by_id[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)] == [1, 2, 3, 4, 5, 5, 7, 7, 7, 10]
    assert by_id[None].component_id == 5 and not by_id[None].kept
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_mixing(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS)
    total = sum(r.size for r in rows)
    targets = {r.source: (r.source_size, r.target) for r in rows}
    assert sum(t for _, t in targets.values()) == pytest.approx(total)
    for r in rows:
        assert r.taken % r.size == 0 if r.size else r.taken == 0
        assert r.taken <= 3 * r.size and r.target <= 3 * r.source_size
    assert sorted(map(tuple, mixing.mix(docs).collect()), key=repr) == sorted(map(tuple, rows), key=repr)
    assert mixing.apply_mix(docs).columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixing_comes_near_its_targets(spark):
    rows = queries.op8_mixing(spark, SMALL).collect()
    sources = {r.doc_id: r.source for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source").collect()}
    taken, largest, targets = Counter(), Counter(), {}
    for r in rows:
        source = sources[r.doc_id]
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
        targets[source] = r.target
    assert all(abs(taken[s] - t) <= largest[s] for s, t in targets.items())


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    expected = Counter()
    for i, text, *_ in ROWS:
        expected[(i, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids) + (0,))] += 1
    rows = packing.pack_documents(docs, keep_ids=True).collect()
    found, fills = Counter(), {}
    for r in rows:
        assert len(r.ids) == r.length
        assert zlib.crc32(np.asarray(r.ids, "<u4").tobytes()) == r.ids_crc32
        fills.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for (i, ids), n in expected.items():
        pieces = sorted((r for r in rows if r.doc_id == i and r.doc_tokens == len(ids)), key=lambda r: r.start)
        assert Counter(tuple(r.ids) for r in pieces) == {tuple(ids[r.start : r.start + r.length]): n for r in pieces}
        assert sum(r.length for r in pieces) == n * len(ids)
    for spans in fills.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert not found and packing.pack_documents(docs.limit(0)).count() == 0


def test_packing_deals_a_repeated_id_to_all_groups(spark):
    docs = spark.createDataFrame([(None if i % 2 else 7, "same text") for i in range(2000)], "doc_id long, text string")
    rows = packing.pack_documents(docs, group_documents=100).collect()
    groups = Counter(r.sequence_id >> 32 for r in rows)
    assert len(rows) == 2000 and len(groups) == 20 and max(groups.values()) < 200


@pytest.mark.parametrize("space", [" ", "\n"])
def test_packing_takes_long_white_space(spark, space):
    from tokenizers import Tokenizer

    text = "one" + space * 1_200_000 + "two"
    ids = Tokenizer.from_file(tokenizer_file()).encode(text, add_special_tokens=False).ids + [0]
    rows = packing.pack_documents(spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string"), keep_ids=True).collect()
    found = sorted((r.start, r.ids) for r in rows if r.doc_id == 1)
    assert [i for _, piece in found for i in piece] == ids and {r.doc_id for r in rows} == {1, 2}


def test_first_fit_decreasing_is_first_fit():
    lengths = np.random.RandomState(0).randint(1, 100, 300)
    bins, offsets = first_fit_decreasing(lengths, 100)
    free = []
    for i in np.argsort(-lengths, kind="stable"):
        place = next((b for b, f in enumerate(free) if f >= lengths[i]), len(free))
        if place == len(free):
            free.append(100)
        assert bins[i] == place and offsets[i] == 100 - free[place]
        free[place] -= lengths[i]


def test_language_id(spark, docs):
    rows = queries.op5_language_id(spark, SMALL).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    model = language_id.train(docs)
    by_id = _by_id(language_id.predict(docs, model))
    assert [by_id[i].lang_pred for i in (1, 2, 3, 13)] == ["und"] * 4
    assert 0 <= by_id[10].score <= 1
    assert language_id.identify_languages(docs.limit(0)).count() == 0


def test_long_text_scores_like_its_parts():
    model = language_id.LanguageModel(["a", "b"], np.random.RandomState(0).rand(language_id.BUCKETS, 2), np.zeros(2))
    text = "abc def " * 50_000
    (whole,) = language_id.logits([text], model)
    parts = language_id.logits([text[:4_000]], model)
    assert whole == pytest.approx(parts[0], rel=1e-3)


def _license_brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [
        (i, label)
        for phrase, label in licenses.RULES and [(r.pattern, r.label) for r in licenses.RULES if r.base]
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def _shortest(parsed):
    """Strings that a parsed pattern fits: every branch, with nothing optional and the first of each class."""
    found = [""]
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            own = [chr(value)]
        elif name == "IN":
            kind, first = value[0]
            own = [chr(first[0] if str(kind) == "RANGE" else first)]
        elif name == "BRANCH":
            own = [x for branch in value[1] for x in _shortest(branch)]
        elif name == "SUBPATTERN":
            own = _shortest(value[3])
        else:
            assert name == "MAX_REPEAT", name
            own = [x * value[0] for x in _shortest(value[2])] if value[0] else [""]
        found = [a + b for a in found for b in own]
    return found


def test_every_license_rule_passes_the_gate():
    for rule in licenses.RULES:
        for sample in _shortest(re._parser.parse(rule.pattern)):
            assert re.search(rule.pattern, sample)
            assert any(f" {anchor}" in f" {sample} " for anchor in licenses.ANCHORS), (rule.name, sample)


def test_license_scan(docs):
    rows = licenses.license_digest(licenses.scan_licenses(docs)).collect()
    texts = {i: t for i, t, *_ in ROWS}
    for r in rows:
        if r.doc_id is not None:
            assert tuple(r)[1:6] == _license_brute(texts[r.doc_id])
    assert len(licenses.RULES) > 300
    (marked,) = [r for r in rows if r.doc_id == 11]
    assert marked.labels == "apache-2.0,mit" and marked.score == 1.0
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def _secrets_brute(text):
    text, spans = text or "", []
    for number, rule in enumerate(secrets.BASE_RULES[:2]):
        for m in re.finditer(rule.pattern, text, re.A):
            if len(m[rule.group]) >= rule.least:
                spans.append((m.start(), number, m.end()))
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    listed = ",".join(f"{secrets.RULES[k].kind}:{s}:{e}" for s, k, e in sorted(spans))
    return hashlib.sha256(listed.encode()).hexdigest()


def test_secret_scan_and_its_ledger(docs):
    texts = {i: t for i, t, *_ in ROWS}
    scanned, ledger = secrets.scan_secrets(docs)
    rows = secrets.secret_digest(scanned).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        if r.doc_id is not None:
            assert r.base_sha256 == _secrets_brute(texts[r.doc_id])
    again, grown = secrets.scan_secrets(docs, ledger)
    assert grown.count() == ledger.count() == len({t or "" for _, t, *_ in ROWS})
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, scanned.collect()), key=repr)
    assert secrets.scan_secrets(docs, ledger, version=2)[1].count() == 2 * ledger.count()
    assert secrets.scan_secrets(docs.limit(0))[0].count() == 0


def test_url_filter(spark):
    given = [
        (1, "http://A.Example.NET/en/x?q"), (2, "http://example.net/de/"), (3, "https://b.org/fr/1#t"), (4, None), (5, ""),
        (6, "no scheme"), (7, "http://net"), (8, "http://example.com/de/1"), (9, "http://é.org/en/" + "a" * 5000), (9, "x://y"),
    ]
    pages = spark.createDataFrame([(*g, "z") for g in given], "page_id long, url string, rule string")
    rows = sorted(map(tuple, urls.filter_urls(pages).select("page_id", "host", "path", "rule").collect()), key=repr)
    assert rows == sorted(
        [
            (1, "a.example.net", "/en/x", "example.net/en/"), (2, "example.net", "/de/", "net/"),
            (3, "b.org", "/fr/1", "org/fr/"), (4, "", "", None), (5, "", "", None), (6, "", "", None),
            (7, "net", "", None), (8, "example.com", "/de/1", "example.com/de/"),
            (9, "é.org", "/en/" + "a" * 5000, None), (9, "y", "", None),
        ],
        key=repr,
    )
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_url_model_tells_all_characters_and_longer_contexts(spark):
    # All but the last pair differ in characters outside a-z0./?-, or in digits; the last one in a symbol four places back.
    pairs = [("_", "="), ("é", "ü"), ("%C3", "%D0"), ("7", "8"), ("😀", "\u0002"), ("abxyz-cdxyw", "abxyw-cdxyz")]
    rules = [("good.org", "/", "allow"), ("evil.org", "/", "block")]
    given = [
        f"http://{host}.org/{'qrs'[i % 3]}{mark}{'tuv'[i % 2]}"
        for pair in pairs for i in range(40) for host, mark in zip(("good", "evil"), pair)
    ]
    first = len(given)
    given += [f"http://none.org/q{mark}t" for pair in pairs for mark in pair]
    pages = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    score = {r.page_id: r.score for r in urls.filter_urls(pages, rules=rules).collect()}
    assert len(score) == len(given)
    for i, pair in enumerate(pairs):
        assert score[first + 2 * i] > score[first + 2 * i + 1], pair
    assert [urls.longest_context(10**i) for i in (0, 3, 5, 7, 9)] == [2, 3, 5, 7, 9]


def test_chat_format(spark):
    turns = [
        (1, 0, "user", "a\\b </s> <|end|>"), (1, 1, "assistant", "<<SYS>> [INST]x[/INST] \\. é😀"), (1, 2, "assistant", None),
        (None, None, None, None), (2, None, "user", ""), (2, 3, "assistant", "tie"), (2, 3, "assistant", "tie"),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(df.withColumn("parts", chat.text_part(df["text"])))
    body = [r.segment[len(chat.TURN) : -len(chat.END)] for r in formatted.collect()]
    assert not any(re.search(r"<\|(?!says)|</?s>|\[/?INST\]|<</?SYS>>", b) for b in body)
    rows = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    for conv in (1, 2, None):
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1], t[2] or "", t[3] or ""))
        said = "".join(f"{r or ''}\n{t or ''}\n" for *_, r, t in own)
        learned = "".join(t or "" for *_, r, t in own if r == "assistant")
        assert rows[conv].n_turns == len(own)
        assert rows[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (rows[conv].loss_chars, rows[conv].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat.read_back(formatted.limit(0)).count() == 0


def test_chat_attachments(spark):
    parts = [("text", "see", None, None, None, None, None), ("image", None, "i.png", 28, 15, None, None), ("audio", None, "a.wav", None, None, 1.5, None)]
    df = spark.createDataFrame([(1, 0, "user", parts)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    (row,) = chat.format_turns(df).collect()
    assert row.segment == "<|turn|>user<|says|>see<|image|><|audio|><|end|>"
    assert [(a.place, a.ref, a.tokens) for a in row.attachments] == [(0, "i.png", 4), (1, "a.wav", 38)]
    assert row.n_expanded == 42


def test_embedding_links(spark):
    rng = np.random.RandomState(5)
    center = rng.randn(16)
    given = [(i, (center + rng.randn(16) * s).tolist(), 0) for i, s in enumerate([0.05] * 40 + [0.15] * 40 + [2.0] * 40)]
    given += [(200 + i, given[3][1], 0) for i in range(5)] + [(300, (2 * np.array(given[4][1])).tolist(), 0)]
    given += [(400, None, 0), (401, [0.0] * 16, 0), (402, [float("nan")] + [1.0] * 15, 0), (403, given[0][1], None), (404, given[0][1], 1), (405, [], 0)]
    df = spark.createDataFrame([(*g, "x") for g in given], "vec_id long, embedding array<double>, label int, kept string")
    rows = {r.vec_id: r for r in embedding_dedup.embedding_links(df, block=32).collect()}
    ids = [g[0] for g in given if g[2] == 0 and g[0] < 400]
    x = np.array([g[1] for g in given if g[0] in set(ids)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.98) & ~np.eye(len(x), dtype=bool)
    component = list(range(len(ids)))
    for _ in ids:
        component = [min([component[i], *(component[j] for j in np.flatnonzero(near[i]))]) for i in range(len(ids))]
    assert len(rows) == len(given)
    for i, vec in enumerate(ids):
        assert (rows[vec].n_links, rows[vec].component_id) == (near[i].sum(), ids[component[i]])
    for vec in range(400, 406):
        assert (rows[vec].n_links, rows[vec].component_id, rows[vec].kept) == (0, vec, True)
    assert embedding_dedup.embedding_links(df.limit(0)).count() == 0


def test_row_keeping_functions_take_any_column_names(spark):
    names = ["_copy", "_times", "_digest", "_id", "_removed", "_again", "a.b", "_source"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{n}` int" for n in names)
    given = [(1, "x y z"), (1, "x  y z"), (2, "x y z"), (3, BASE), (4, NEAR), (None, BASE), (None, "q r s"), (5, "")]
    docs = spark.createDataFrame([(i, t, "s", *range(42, 42 + len(names))) for i, t in given], schema)

    def ids(df):
        assert df.columns == docs.columns
        rows = df.collect()
        assert all(tuple(r)[3:] == tuple(range(42, 42 + len(names))) for r in rows)
        return sorted((r.doc_id is None, r.doc_id) for r in rows)

    assert ids(exact_dedup.drop_exact_duplicates(docs)) == [(False, i) for i in (1, 3, 4, 5)] + [(True, None)]
    assert ids(near_dedup.drop_near_duplicates(docs)) == [(False, 1), (False, 3), (False, 5), (True, None)]
    model = language_id.LanguageModel(["xx"], np.zeros((language_id.BUCKETS, 1), np.float32), np.zeros(1))
    assert len(ids(language_id.keep_identified(docs, model, 0.5))) == len(given) - 1
    assert {i for i, _ in ids(mixing.apply_mix(docs))} == {False, True}


def test_near_dedup_of_repeated_and_null_ids(spark):
    other = " ".join(f"v{i}" for i in range(300))
    edited = other.replace("v100 ", "w100 ")
    given = [(1, BASE), (1, other), (2, NEAR), (3, edited), (None, BASE.upper()), (None, "lone words here"), (None, "Lone words here"), (4, "")]
    rows = near_dedup.near_duplicates(spark.createDataFrame(given, "doc_id long, text string").repartition(4), 3, 85).collect()
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in rows), key=repr)
    # The two texts of id 1 are two components, each with id 1.
    assert found == sorted(
        [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (None, 1, False), (None, None, True), (None, None, False), (4, 4, True)],
        key=repr,
    )
    stay = near_dedup.drop_near_duplicates(spark.createDataFrame(given, "doc_id long, text string"), 3, 85).collect()
    assert sorted((r.doc_id, len(r.text)) for r in stay if r.doc_id) == sorted([(1, len(BASE)), (1, len(other)), (4, 0)])
    assert len(stay) == 4


def _components_brute(rows, width, percent):
    """Smallest id of each component, over all pairs that share a word shingle."""
    sets = {}
    for i, text in rows:
        words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", words) if w]
        used = min(width, len(words))
        sets[i] = frozenset(tuple(words[k : k + used]) for k in range(len(words) - used + 1)) if words else frozenset()
    holders = {}
    for i, own in sets.items():
        for shingle in own:
            holders.setdefault(shingle, []).append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, own in sets.items():
        shared = Counter(j for shingle in own for j in holders[shingle] if j < i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(own), root(i)) for i, own in sets.items()}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_dedup_of_a_whole_table_equals_brute_force(spark, width, percent):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs, width, percent).collect()}
    assert found == _components_brute(given, width, percent)


def test_sketches_estimate_and_bound(spark):
    rng = np.random.RandomState(1)
    pool = np.unique(rng.randint(0, 2**63, 3000).astype(np.uint64))
    for size in (1, 30, 400, 2000):
        for shared in (0.2, 0.6, 0.9):
            a = pool[:size]
            b = np.sort(np.concatenate([a[: int(size * shared)], pool[2000 : 2000 + size - int(size * shared)]]))
            true = int(size * shared) / (2 * size - int(size * shared))
            equal = (setsketch.registers(a) == setsketch.registers(b)).mean()
            assert abs(equal - true) < 0.12
            bits = np.bitwise_count((setsketch.odd_sketch(a) ^ setsketch.odd_sketch(b)).view(np.uint64)).sum()
            assert bits <= 2 * (size - int(size * shared))
    union = np.maximum(setsketch.registers(pool[:700]), setsketch.registers(pool[500:1500]))
    assert (union == setsketch.registers(pool[:1500])).all()
    assert [setsketch.band_rows(t) for t in (0.8, 0.85)] == [7, 9]


def test_many_detections_in_one_text(spark):
    # Forty thousand detections took minutes when each kept one copied the array before it.
    text = "mit license " * 20_000 + "Apache License Version 2.0 mit license"
    began = time.monotonic()
    (row,) = licenses.license_digest(licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string"))).collect()
    assert row.n_base == 20_002 and time.monotonic() - began < 60
    assert tuple(row)[1:6] == _license_brute(text)


def test_suppression_equals_brute_force(spark):
    rng = random.Random(8)
    levels = sorted({r.priority for r in licenses.RULES})
    given = []
    for i in range(12):
        found = {(s, s + rng.randint(1, 9), rng.choice(levels), rng.randint(0, 5)) for s in (rng.randint(0, 400) for _ in range(i * 60))}
        given.append((i, sorted(found, key=lambda d: (d[0], -d[1], -d[2], d[3]))))
    df = spark.createDataFrame(given, f"doc_id long, found array<{licenses._DETECTION}>")
    kept = df.select("doc_id", licenses._unsuppressed(df["found"], licenses.RULES).alias("kept")).collect()
    for i, found in given:
        expected = [d for k, d in enumerate(found) if not any(o[1] >= d[1] and o[2] >= d[2] for o in found[:k])]
        assert [tuple(d) for d in next(r.kept for r in kept if r.doc_id == i)] == expected


def test_packing_groups_follow_the_pieces_of_long_texts(spark):
    docs = spark.createDataFrame([(i, "word " * 60_000) for i in range(3)], "doc_id long, text string")
    rows = packing.pack_documents(docs, group_documents=10).collect()
    groups = Counter(r.sequence_id >> 32 for r in rows)
    assert len(rows) > 150 and max(groups.values()) < 80


def _links_brute(given, cosine=0.98):
    """(links, smallest linked id) of each vector of the rows, over all pairs of a label."""
    found = {}
    for label in {g[2] for g in given}:
        own = [g for g in given if g[2] == label]
        x = np.array([g[1] for g in own], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = (x @ x.T >= cosine) & ~np.eye(len(own), dtype=bool)
        ids, component = [g[0] for g in own], [g[0] for g in own]
        while True:
            lower = [min([component[i], *(component[j] for j in np.flatnonzero(near[i]))]) for i in range(len(own))]
            if lower == component:
                break
            component = lower
        found |= {i: (int(near[k].sum()), component[k]) for k, i in enumerate(ids)}
    return found


def _clustered(count, rng, clusters, size=24):
    centers = rng.randn(clusters, size)
    return [(i, (centers[i % clusters] + rng.randn(size) * 0.08).tolist(), i % 3) for i in range(count)]


def test_embedding_links_over_several_labels_and_levels(spark):
    rng = np.random.RandomState(12)
    given = _clustered(1500, rng, 60)
    given += [(5000 + i, (np.array(given[7][1]) * (1 + i)).tolist(), given[7][2]) for i in range(100)]
    df = spark.createDataFrame([(*g, "x") for g in given], "vec_id long, embedding array<double>, label int, cell string").repartition(5)
    rows = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.embedding_links(df, block=24).collect()}
    assert rows == _links_brute(given)


def test_pairs_of_leaves_grow_with_the_rows(spark):
    rng, met = np.random.RandomState(13), []
    for count in (1000, 4000):
        given = [(i, v, 0) for i, v, _ in _clustered(count, rng, count // 20)]
        df = spark.createDataFrame(given, "vec_id long, embedding array<double>, label int")
        classes = embedding_dedup._classes(df, "vec_id", "embedding", "label")
        leaves, pairs = embedding_dedup._leaves(classes, 32, 0.21)
        cells = leaves.select("cell").distinct().count()
        assert leaves.count() == count
        met.append((cells, pairs.count()))
    (few, small), (many, large) = met
    assert large < 8 * small and large < 0.2 * many * many


def _shuffled(spark):
    """Bytes of the shuffle files that there are."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(f.stat().st_size for folder in folders for f in Path(folder.getPath()).rglob("shuffle_*"))


def test_blocks_of_vectors_without_structure_are_not_dealt_per_pair(spark):
    rng = np.random.RandomState(14)
    x = rng.randn(6000, 64).astype(np.float32)
    x[4000:] = x[0] + rng.randn(2000, 64) * 0.1
    given = [(i, v, 0) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(given, "vec_id long, embedding array<float>, label int").repartition(4).cache()
    assert df.count() == 6000
    before = _shuffled(spark)
    rows = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.embedding_links(df, block=64).collect()}
    assert _shuffled(spark) - before < 2 * x.nbytes
    assert rows == _links_brute(given)


def test_embedding_links_with_guests_and_sketches(spark):
    rng = np.random.RandomState(15)
    given = _clustered(300, rng, 15) + [(1000 + i, rng.randn(24).tolist(), i % 3) for i in range(1500)]
    given += [(5000 + i, given[300 + i][1], given[300 + i][2]) for i in range(60)]
    given = [(i, np.float32(v).tolist(), label) for i, v, label in given]
    near = _links_brute(given)
    for kind in ("float", "double"):
        df = spark.createDataFrame(given, f"vec_id long, embedding array<{kind}>, label int").repartition(7)
        for block, bundle, sketches in ((16, 150, 10**6), (32, 90, 130), (1024, 300, 200)):
            links = embedding_dedup.embedding_links(df, block=block, bundle=bundle * 24 * 4, sketches=sketches)
            assert {r.vec_id: (r.n_links, r.component_id) for r in links.collect()} == near
    classes = embedding_dedup._classes(df, "vec_id", "embedding", "label")
    sizes = embedding_dedup._sizes(classes)
    left, _ = embedding_dedup._partnered(classes, sizes, 0.2 + 1e-6, 300 * 24 * 4, 200)
    ids = {r.id for r in left.collect()}
    assert {i for i, (n, _) in near.items() if n} <= ids | {i for i in near if i >= 5000}
    assert len(ids) < 500


def test_rank_form_and_tokenizer_give_equal_ids_over_a_whole_table(spark):
    path, ranks = tokenizer_file(), tokenizer_file("byte_bpe_50k.tiktoken")
    tokenizer = packing._tokenizer(path)
    encoder = packing.Encoder(path, ranks, [t.content for t in tokenizer.get_added_tokens_decoder().values()])
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    for text, encoded in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoded.ids
    assert "tokenizer" not in vars(encoder)


def test_secret_ledger_in_a_folder_scans_only_unseen_pairs(spark, tmp_path):
    key, other = "AKIAABCDEFGHIJKL12", "AKIAZZZZZZZZZZZZ99"
    rules = secrets.RULES[:3]
    ledger = secrets.SecretLedger(spark, f"{tmp_path}/ledger")

    def table(*rows):
        return spark.createDataFrame(rows, "doc_id long, text string")

    def pairs(run):
        return Counter(r.rule.split("-")[0] for r in ledger.rows().where(f"_run = '{run}'").collect())

    first = table((1, f"a {key}"), (2, f"a {key}"), (3, None), (4, "nothing"))
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in ledger.scan(first, "one", rules).collect()}
    assert found == {1: [(2, 1, 20)], 2: [(2, 1, 20)], 3: [], 4: []}
    assert pairs("one") == {"assign": 3, "access": 3, "hex": 3}
    # The same run again replaces its rows; another one over the same texts scans nothing.
    ledger.scan(first, "one", rules)
    ledger.scan(first, "two", rules)
    assert pairs("one") == {"assign": 3, "access": 3, "hex": 3} and not pairs("two")

    # A changed text, a new version of an id, a copy of an old text; and one changed rule.
    changed = [rules[0], secrets.SecretRule("access", r"AKIA[A-Z0-9]+", ("akia",), least=10), rules[2]]
    second = table((1, f"b {other}"), (2, f"a {key}"), (4, "nothing"), (4, f"b {other}"), (None, f"a {key}"))
    found = sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in ledger.scan(second, "three", changed).collect()), key=repr)
    assert found == sorted([(1, [(2, 1, 20)]), (2, [(2, 1, 20)]), (4, []), (4, [(2, 1, 20)]), (None, [(2, 1, 20)])], key=repr)
    assert pairs("three") == {"assign": 1, "access": 3, "hex": 1}
    whole = ledger.scan(spark.read.parquet(f"{SMALL}/documents.parquet"), "four")
    plain, _ = secrets.scan_secrets(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    assert ledger.scan(first.limit(0), "five").count() == 0
