"""Secret scans over an incremental ledger of content-addressed blobs, in column expressions only.

A path's text is a blob named by its SHA-256. The ledger holds the spans of
every (blob, rule version) scanned so far. A run hashes all paths, keeps the pairs
the ledger has not seen, fetches one text of each and scans it, appends the
result and joins the ledger's findings back to all paths. Copies and unchanged
versions are never scanned again; a new rule version scans everything once.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwell.llm.common import built_side, whole_text, written
from stockwell.llm.native import match_spans
from stockwell.sources.files import path_exists

RULE_VERSION = 1


@dataclass(frozen=True)
class SecretRule:
    kind: str
    pattern: str
    #: Texts that hold none of these, in lower case, cannot match.
    keywords: tuple[str, ...] = ()
    #: Matches are kept if this group of theirs has so many characters.
    group: int = 0
    least: int = 0


#: Fixed patterns, in the order in which equal starts are listed.
BASE_RULES = [
    SecretRule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        ("passw", "secret", "token", "api"),
        group=2,
        least=8,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]+", ("akia",), least=16),
    # Every maximal run of at least 32: the same matches as all runs, short ones dropped.
    SecretRule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}"),
]
#: Further kinds of this library.
MORE_RULES = [
    SecretRule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", ("private key",)),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", ("eyj",)),
    SecretRule("forge_token", r"(?:gh[opsur]|glpat)[_-][A-Za-z0-9_-]{20,}", ("gh", "glpat")),
    SecretRule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", ("xox",)),
    SecretRule("cloud_key", r"AIza[A-Za-z0-9_-]{35}", ("aiza",)),
    SecretRule("payment_key", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}", ("k_live", "k_test")),
    SecretRule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/-]{20,}=*", ("bearer",)),
    SecretRule("url_password", r"[a-z][a-z0-9+.-]{1,20}://[^/\s:@\"']{1,64}:[^/\s:@\"']{3,128}@", ("://",)),
]
RULES = BASE_RULES + MORE_RULES
_SPAN = "struct<start:bigint,kind:int,end:bigint>"


def _rule_spans(text: Column, lowered: Column, number: int, rule: SecretRule) -> Column:
    pattern = F.lit(rule.pattern)
    spans = match_spans(text, pattern)
    if rule.least:
        value = (lambda m: F.regexp_extract(m, rule.pattern, rule.group)) if rule.group else (lambda m: m)
        spans = F.filter(spans, lambda s: F.length(value(s["match"])) >= rule.least)
    own = F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"))
    ).cast(f"array<{_SPAN}>")
    may = F.regexp_like(text, pattern)
    for word in rule.keywords[:1]:
        held = F.contains(lowered, F.lit(word))
        for other in rule.keywords[1:]:
            held = held | F.contains(lowered, F.lit(other))
        may = held & may
    return F.when(may, own).otherwise(F.array().cast(f"array<{_SPAN}>"))


def secret_spans(text: Column, lowered: Column, rules: list[SecretRule] = RULES) -> Column:
    """Spans of all rules by start, then by the rules' order."""
    return F.array_sort(F.concat(*[_rule_spans(text, lowered, i, r) for i, r in enumerate(rules)]))


def blobs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.sha2(whole_text(text_col), 256).alias("blob"))


def scan_unseen(
    docs: DataFrame,
    paths: DataFrame,
    ledger: DataFrame | None = None,
    rules: list[SecretRule] = RULES,
    version: int = RULE_VERSION,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """New ledger rows ``blob, rule_version, spans`` for pairs not in ``ledger``.

    Only hashes and ids are grouped. One row of each unseen blob is fetched by
    its id; the built side of that join is ids, so texts are not sorted.
    """
    unseen = paths.groupBy("blob").agg(F.min("doc_id").alias("_id"))
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == version).select("blob")
        unseen = unseen.join(seen, "blob", "left_anti")
    texts = docs.select(F.col(id_col).alias("_key"), whole_text(text_col).alias("_text"))
    # A blob all of whose ids are null is found by its null id.
    fetched = texts.withColumn("blob", F.sha2("_text", 256)).join(
        unseen.withColumnRenamed("blob", "_blob").hint("shuffle_hash"),
        F.col("_key").eqNullSafe(F.col("_id")) & (F.col("blob") == F.col("_blob")),
        "left_semi",
    )
    lowered = fetched.withColumn("_lowered", F.lower("_text"))
    spans = secret_spans(F.col("_text"), F.col("_lowered"), rules)
    scanned = lowered.select("blob", F.lit(version).alias("rule_version"), spans.alias("spans"))
    # Rows that repeat id and text are one blob; their spans are equal.
    return scanned.dropDuplicates(["blob"]) if rules else scanned


def scan_secrets(
    docs: DataFrame,
    ledger: DataFrame | None = None,
    rules: list[SecretRule] = RULES,
    version: int = RULE_VERSION,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """``doc_id, blob, spans`` of every path, and the grown ledger.

    Each span has ``start, kind, end``: code points, end exclusive, and the number
    of the rule. Null and empty texts are one blob without spans. Repeated rows are
    separate paths of one blob; an empty table gives no rows and leaves the ledger
    as it is; other columns are not read.
    """
    paths = written(blobs(docs, id_col, text_col), "paths")
    fresh = written(scan_unseen(docs, paths, ledger, rules, version, id_col, text_col), "ledger")
    grown = fresh if ledger is None else ledger.unionByName(fresh)
    found = grown.where((F.col("rule_version") == version) & (F.size("spans") > 0)).select("blob", "spans")
    none = F.array().cast(f"array<{_SPAN}>")
    return paths.join(found, "blob", "left").select("doc_id", "blob", F.coalesce("spans", none).alias("spans")), grown


def rule_name(rule: SecretRule) -> str:
    """A rule's kind and a digest of all it says: a changed rule is another rule."""
    told = repr((rule.kind, rule.pattern, rule.keywords, rule.group, rule.least))
    return f"{rule.kind}-{hashlib.sha256(told.encode()).hexdigest()[:16]}"


class SecretLedger:
    """A ledger in a folder of its own, with a row for each blob and rule ever scanned.

    Every run appends its rows under its own name. A run that is repeated, say after it was lost
    halfway, replaces them; what other runs have scanned is never scanned again. A new
    or changed rule is scanned alone, over all blobs.
    """

    _schema = "blob string, rule string, spans array<struct<start:bigint,end:bigint>>, _run string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def rows(self) -> DataFrame:
        """``blob, rule, spans, _run`` of all runs."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self._schema)
        return self.spark.read.schema(self._schema).parquet(self.path)

    def scan(
        self, docs: DataFrame, run: str, rules: list[SecretRule] = RULES, id_col: str = "doc_id", text_col: str = "text"
    ) -> DataFrame:
        """``doc_id, blob, spans`` of every path, as :func:`scan_secrets` has them, after scanning what is unseen.

        Null and empty texts are one blob. Rows that repeat an id are versions, each a path of its
        own blob. An empty table scans nothing and gives no rows; other columns are not read.
        """
        names = [rule_name(r) for r in rules]
        paths = written(blobs(docs, id_col, text_col), "paths")
        wanted = paths.groupBy("blob").agg(F.min("doc_id").alias("_id")).withColumn("rule", F.explode(_names(names)))
        seen = self.rows().where(F.col("_run") != run).select("blob", "rule")
        unseen = wanted.join(seen, ["blob", "rule"], "left_anti").groupBy("blob", "_id").agg(F.collect_set("rule").alias("_rules"))
        self._append(docs, written(unseen, "unseen"), names, rules, run, id_col, text_col)

        number = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i)])
        known = self.rows().where(F.col("rule").isin(names) & (F.size("spans") > 0)).dropDuplicates(["blob", "rule"])
        kind = F.element_at(number, F.col("rule"))
        spans = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), kind.alias("kind"), s["end"].alias("end")))
        found = known.select("blob", spans.cast(f"array<{_SPAN}>").alias("spans")).groupBy("blob").agg(
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")
        )
        none = F.array().cast(f"array<{_SPAN}>")
        return paths.join(found, "blob", "left").select("doc_id", "blob", F.coalesce("spans", none).alias("spans"))

    def _append(self, docs, unseen, names, rules, run, id_col, text_col) -> None:
        texts = docs.select(F.col(id_col).alias("_key"), whole_text(text_col).alias("_text"))
        named = built_side(unseen.withColumnRenamed("blob", "_blob"))
        fetched = texts.withColumn("blob", F.sha2("_text", 256)).join(
            named, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("blob") == F.col("_blob"))
        )
        lowered = fetched.withColumn("_lowered", F.lower("_text"))
        ends = F.array().cast("array<struct<start:bigint,end:bigint>>")
        each = []
        for i, (name, rule) in enumerate(zip(names, rules)):
            spans = _rule_spans(F.col("_text"), F.col("_lowered"), i, rule)
            own = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
            wanted = F.array_contains("_rules", name)
            each.append(F.when(wanted, F.struct(F.lit(name).alias("rule"), F.coalesce(own, ends).alias("spans"))))
        rows = lowered.select("blob", F.explode(F.array_compact(F.array(*each))).alias("r")).select("blob", "r.rule", "r.spans")
        # Versions that repeat id and text are one blob.
        once = rows.dropDuplicates(["blob", "rule"]).withColumn("_run", F.lit(run))
        once.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_run").parquet(self.path)


def _names(names: list[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def secret_digest(scanned: DataFrame, rules: list[SecretRule] = RULES) -> DataFrame:
    kinds = F.array(*[F.lit(r.kind) for r in rules])

    def listed(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(
                    ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
                ),
            ),
            ",",
        )

    def counted(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] < len(BASE_RULES))
    return scanned.select(
        "doc_id",
        counted(0).alias("n_assign"),
        counted(1).alias("n_access"),
        counted(2).alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
