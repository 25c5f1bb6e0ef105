"""Licence scans with ordered signature rules, in column expressions only.

Texts become lower-case words with one space between them. A text that holds none
of a few anchors ends there; else each rule is tried only if one of its keywords
stands in the text. All detections of a text are put in order, and one that lies inside a
detection of at least its own priority is suppressed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwell.llm.common import whole_text
from stockwell.llm.license_rules import ANCHORS, RULES, Rule
from stockwell.llm.native import in_chunks, let

_DETECTION = "struct<start:bigint,end:bigint,priority:int,rule:int>"


def normal_words(text: Column) -> Column:
    """`` w1 w2 ... wn ``: words in lower case, a space before and after each.

    Lower-casing beyond A-Z neither joins nor splits words, and no letter outside
    A-Z becomes one that a rule's words hold (only the kelvin sign becomes ASCII).
    """
    spaced = F.regexp_replace(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.concat(F.lit(" "), F.trim(spaced), F.lit(" "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _word_spans(words: Column, pattern: Column) -> Column:
    """``start, end`` of matches in words: marks, which no word holds, are set around each."""
    marked = F.regexp_replace(words, pattern, F.lit("\x01$0\x02"))

    def spans(marks):
        starts = F.filter(F.transform(marks, lambda w, i: F.when(F.startswith(w, F.lit("\x01")), i)), F.isnotnull)
        ends = F.filter(F.transform(marks, lambda w, i: F.when(F.endswith(w, F.lit("\x02")), i + 1)), F.isnotnull)
        return F.zip_with(
            starts, ends, lambda s, e: F.struct(s.cast("bigint").alias("start"), e.cast("bigint").alias("end"))
        )

    return let(F.split(F.trim(marked), " "), spans)


def _literal(values: list[str]) -> Column:
    """An array built from SQL literals in one call; the optimizer folds it to a constant."""
    return F.expr(f"array({', '.join(values)})")


def _rule_table(rules: list[Rule]) -> Column:
    return _literal(
        [
            f"named_struct('rule', {i}, 'keywords', array({', '.join(f"'{k}'" for k in r.keywords)}), "
            f"'pattern', r'(?<= )(?:{r.pattern})(?= )', 'priority', {r.priority})"
            for i, r in enumerate(rules)
        ]
    )


def _found(words: Column, rules: list[Rule]) -> Column:
    """All detections in order of start, longest and highest first."""
    tried = F.filter(
        _rule_table(rules),
        lambda r: F.exists(r["keywords"], lambda k: F.contains(words, k)) & F.regexp_like(words, r["pattern"]),
    )
    spans = F.flatten(
        F.transform(
            tried,
            lambda r: F.transform(
                _word_spans(words, r["pattern"]),
                lambda s: F.struct(
                    s["start"].alias("start"),
                    (-s["end"]).alias("last"),
                    (-r["priority"]).alias("rank"),
                    r["rule"].alias("rule"),
                ),
            ),
        )
    )
    return F.transform(
        F.array_sort(spans),
        lambda s: F.struct(
            s["start"].alias("start"), (-s["last"]).alias("end"), (-s["rank"]).alias("priority"), s["rule"].alias("rule")
        ),
    )


def _unsuppressed(found: Column, rules: list[Rule]) -> Column:
    """Detections not inside an earlier one of the same or a higher priority.

    In this order only an earlier detection can contain a later one, so it is
    enough to know how far detections of each priority have reached. Detections are
    taken in chunks: the reach before each chunk comes first, so no array grows with the
    number of detections squared.
    """
    levels = sorted({r.priority for r in rules})
    order = F.array(*[F.lit(p) for p in levels])
    nowhere = F.array(*[F.lit(-1).cast("bigint")] * len(levels))

    def further(reach, d):
        return F.zip_with(
            reach, order, lambda to, level: F.when(level == d["priority"], F.greatest(to, d["end"])).otherwise(to)
        )

    def before(chunks):
        start = F.struct(nowhere.alias("reach"), F.array().cast("array<array<bigint>>").alias("seen"))
        return F.aggregate(
            chunks,
            start,
            lambda acc, c: F.struct(
                F.aggregate(c, acc["reach"], further).alias("reach"),
                F.concat(acc["seen"], F.array(acc["reach"])).alias("seen"),
            ),
            lambda acc: acc["seen"],
        )

    def step(acc, d):
        covered = F.exists(
            F.arrays_zip(acc["reach"].alias("to"), order.alias("level")),
            lambda x: (x["level"] >= d["priority"]) & (x["to"] >= d["end"]),
        )
        kept = F.when(covered, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(d.cast(_DETECTION))))
        return F.struct(further(acc["reach"], d).alias("reach"), kept.alias("kept"))

    def kept_of(chunk, reach):
        start = F.struct(reach.alias("reach"), F.array().cast(f"array<{_DETECTION}>").alias("kept"))
        return F.aggregate(chunk, start, step, lambda acc: acc["kept"])

    return let(in_chunks(found), lambda chunks: F.flatten(F.zip_with(chunks, before(chunks), kept_of)))


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, found, kept``.

    ``found`` holds all detections and ``kept`` those not suppressed, as arrays of
    ``start, end`` (words from 0, end exclusive), ``priority`` and ``rule`` (its number).
    Null and empty texts and texts without an anchor have empty arrays. Rows are
    independent, so repeats and ties change nothing; an empty table gives no
    rows; other columns are not read.
    """
    words = docs.select(F.col(id_col).alias("doc_id"), normal_words(whole_text(text_col)).alias("_words"))
    anchored = F.lit(False)
    for anchor in ANCHORS:
        anchored = anchored | F.contains("_words", F.lit(f" {anchor}"))
    none = F.array().cast(f"array<{_DETECTION}>")
    n_words = F.when(F.col("_words") == "  ", 0).otherwise(_spaces(F.col("_words")) - 1)
    found = F.when(anchored, _found(F.col("_words"), rules).cast(f"array<{_DETECTION}>")).otherwise(none)
    scanned = words.select("doc_id", n_words.cast("bigint").alias("n_words"), found.alias("found"))
    kept = F.when(F.size("found") > 0, _unsuppressed(F.col("found"), rules)).otherwise(none)
    return scanned.select("doc_id", "n_words", "found", kept.alias("kept"))


def license_digest(scanned: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Counts, places, labels and the best certainty of each text's detections."""
    labels = _literal([f"'{r.label}'" for r in rules])
    scores = _literal([f"{r.score}D" for r in rules])
    bases = _literal([str(i) for i, r in enumerate(rules) if r.base])
    base = F.filter("found", lambda d: F.array_contains(bases, d["rule"]))
    starts = F.transform(base, lambda d: d["start"])

    def named(detections):
        return F.array_distinct(F.transform(detections, lambda d: F.element_at(labels, d["rule"] + 1)))

    def listed(names):
        return F.array_join(F.array_sort(names), ",")

    score = F.coalesce(F.array_max(F.transform("kept", lambda d: F.element_at(scores, d["rule"] + 1))), F.lit(0.0))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        listed(named(base)).alias("base_labels"),
        listed(F.array_union(named(base), named(F.col("kept")))).alias("labels"),
        score.alias("score"),
    )
