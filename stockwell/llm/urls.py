"""URL filters by a character language-model ratio, in column expressions only.

Hand-written rules decide the urls they fit and thereby label them. Over all
labelled urls the characters after every context are counted for accepted and
rejected ones. Each side's model backs off from longer to shorter contexts by
Witten-Bell smoothing, so a context weighs by how often and how variedly it was
seen. Other urls are judged by the difference of both log likelihoods per
character against a threshold calibrated on labelled urls, each scored by the
model of the other half of them.

Characters are taken as they are. The longest context grows with the logarithm
of the labelled characters, and a context is used where it was seen often enough,
so the model is a table that grows with the input. Scoring joins it by distinct
grams, one level of context length after the other: a gram has at most one longer
gram for each symbol, so no key of these joins can hold more rows than that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockwell.llm.common import written
from stockwell.llm.native import let

#: (host, path, verdict): a rule fits its host and all subdomains; the longest fitting rule wins.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
#: Edges of a url as symbols; where a url itself holds one of these three it follows the first.
ESCAPE, START, END = "\u0001", "\u0002", "\u0003"
#: A context is used where it was seen this often among labelled urls.
LEAST_COUNT = 2
#: The longest context: so many symbols that contexts of three bits each outnumber the labelled characters no more.
LEAST_ORDER, BITS = 2, 3
#: The models: of all labelled urls, and of those outside each half.
MODELS = ((0, 1), (1,), (0,))
#: Scores are calibrated in steps of a hundredth between these bounds.
LOWEST, HIGHEST = -500, 500


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.lit(2**31 - 1))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, lower)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The winning rule's text and verdict, or nulls."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, decision in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(rule_path))
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def url_grams(url: Column, order: int) -> Column:
    """Each character and the end, behind the ``order`` symbols before it."""
    escaped = F.regexp_replace(url, f"([{ESCAPE}-{END}])", f"{ESCAPE}$1")
    symbols = F.split(F.concat(F.lit(START * order), escaped, F.lit(END)), "")

    def windows(padded):
        return F.transform(
            F.sequence(F.lit(1), F.size(padded) - order), lambda i: F.array_join(F.slice(padded, i, F.lit(order + 1)), "")
        )

    return let(F.filter(symbols, lambda c: c != ""), windows)


def longest_context(characters: int) -> int:
    """The number of symbols of the longest context for so many labelled characters."""
    return max(LEAST_ORDER, (max(1, characters).bit_length() - 1) // BITS)


def distinct_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``url_id, url, n, cell`` of each different url.

    ``cell`` is null without a rule, else the half (0 or 1) the url belongs to,
    plus 2 if the rule rejects it.
    """
    _, verdict = matched_rule(*url_parts(F.col("url")), rules)
    half = F.pmod(F.xxhash64("url"), F.lit(2)).cast("int")
    cell = F.when(verdict == "allow", half).when(verdict.isNotNull(), half + 2)
    counted = pages.groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    return written(counted.select(F.monotonically_increasing_id().alias("url_id"), "url", "n", cell.alias("cell")), "urls")


def gram_shares(positions: DataFrame, order: int) -> DataFrame:
    """``k, gram`` of every context of k symbols and its next one, with shares by model and side.

    With n observations of a context and t different symbols after it, ``own`` is the
    symbol's count by n + t and ``rest`` is t / (n + t), which goes to the next shorter
    context. A context that is not kept passes all of it on.
    """
    cells = [f"n{i}" for i in range(4)]
    longest = positions.groupBy("gram").agg(
        *[F.sum(F.when(F.col("cell") == i, F.col("n")).otherwise(0)).alias(c) for i, c in enumerate(cells)]
    )
    suffixes = F.transform(
        F.sequence(F.lit(0), F.lit(order)),
        lambda k: F.struct(k.alias("k"), F.substring(F.col("gram"), order + 1 - k, k + 1).alias("gram")),
    )
    counts = longest.select(F.explode(suffixes).alias("s"), *cells).groupBy("s.k", "s.gram").agg(
        *[F.sum(c).alias(c) for c in cells]
    )
    over = Window.partitionBy("k", "_context")
    sides, totals = [], []
    for m, halves in enumerate(MODELS):
        for side in (0, 1):
            n = sum((F.col(cells[h + 2 * side]) for h in halves), F.lit(0))
            sides.append(n.alias(f"c{m}{side}"))
            count = F.col(f"c{m}{side}")
            totals += [F.sum(count).over(over).alias(f"n{m}{side}"), F.sum((count > 0).cast("int")).over(over).alias(f"t{m}{side}")]
    context = F.substring(F.col("gram"), F.lit(1), F.col("k")).alias("_context")
    seen = counts.select("k", "gram", context, *sides).select("*", *totals)
    shares = []
    for m, _ in enumerate(MODELS):
        kept = F.col(f"n{m}0") + F.col(f"n{m}1") >= LEAST_COUNT
        for side in (0, 1):
            n, t = F.col(f"n{m}{side}"), F.col(f"t{m}{side}")
            used = kept & (n > 0)
            shares += [
                F.when(used, F.col(f"c{m}{side}") / (n + t)).otherwise(0.0).alias(f"own{m}{side}"),
                F.when(used, t / (n + t)).otherwise(1.0).alias(f"rest{m}{side}"),
            ]
    return seen.select("k", "gram", *shares)


def gram_ratios(shares: DataFrame, order: int, symbols: int) -> DataFrame:
    """``gram, ratio0, ratio1, ratio2``: the accepted side's log probability less the rejected one's, by model."""
    pairs = [f"{m}{side}" for m in range(len(MODELS)) for side in (0, 1)]

    def mixed(shorter):
        return [(F.col(f"own{x}") + F.col(f"rest{x}") * shorter(x)).alias(f"p{x}") for x in pairs]

    level = shares.where(F.col("k") == 0).select("gram", *mixed(lambda _: F.lit(1.0 / symbols)))
    for k in range(1, order + 1):
        shorter = level.select(F.col("gram").alias("_suffix"), *[F.col(f"p{x}").alias(f"q{x}") for x in pairs])
        longer = shares.where(F.col("k") == k).withColumn("_suffix", F.substring("gram", 2, k))
        level = longer.join(shorter, "_suffix").select("gram", *mixed(lambda x: F.col(f"q{x}")))
    # Decimals, so that sums over a url do not depend on the order of its rows.
    ratios = [(F.ln(f"p{m}0") - F.ln(f"p{m}1")).cast("decimal(18,9)").alias(f"ratio{m}") for m in range(len(MODELS))]
    return level.select("gram", *ratios)


def score_urls(urls: DataFrame) -> DataFrame:
    """``url, n, cell, score, outside``: the mean log-likelihood difference of a url's characters and its end.

    ``score`` is by the model of all labelled urls, ``outside`` by that of the half without the url.
    """
    labelled = urls.where(F.col("cell").isNotNull()).agg(F.sum(F.length("url").cast("long")).alias("characters"))
    order = longest_context(labelled.first()["characters"] or 0)
    positions = written(urls.select("url_id", "cell", "n", F.explode(url_grams(F.col("url"), order)).alias("gram")), "grams")
    shares = written(gram_shares(positions, order), "shares")
    symbols = max(1, shares.where(F.col("k") == 0).count())
    found = positions.join(gram_ratios(shares, order, symbols), "gram")
    outside = F.when(F.col("cell") % 2 == 0, F.col("ratio1")).otherwise(F.col("ratio2"))

    def mean(ratio):
        return F.round(F.sum(ratio).cast("double") / F.count(F.lit(1)), 6)

    scores = found.groupBy("url_id").agg(mean("ratio0").alias("score"), mean(outside).alias("outside"))
    return written(urls.join(scores, "url_id").select("url", "n", "cell", "score", "outside"), "scores")


def calibrated_threshold(scores: DataFrame) -> float:
    """The score with the least sum of both sides' error rates; 0 if a side is empty.

    A url counts with its score by the half without it, unless a half lacks a side.
    """
    labelled = scores.where(F.col("cell").isNotNull())
    cells = labelled.select("cell").distinct().count()
    score = F.col("outside" if cells == 4 else "score")
    step = F.least(F.greatest(F.floor(score * 100), F.lit(LOWEST)), F.lit(HIGHEST))
    # At most HIGHEST - LOWEST + 1 rows for each side.
    counts = labelled.groupBy((F.col("cell") < 2).alias("accepted"), step.alias("step")).agg(F.sum("n").alias("n")).collect()
    sides = {side: {r["step"]: r["n"] for r in counts if r["accepted"] == side} for side in (True, False)}
    totals = {side: sum(bins.values()) for side, bins in sides.items()}
    if not all(totals.values()):
        return 0.0
    best, lost, passed = None, 0, totals[False]
    for step_ in range(LOWEST, HIGHEST + 2):
        error = lost / totals[True] + passed / totals[False]
        if best is None or error < best[0]:
            best = (error, step_)
        lost += sides[True].get(step_, 0)
        passed -= sides[False].get(step_, 0)
    return best[1] / 100


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, score``.

    ``score`` is the model's for every url; the verdict is the rule's, else allow
    where the score reaches the calibrated threshold. A null url is scored as an empty
    one. Without labelled urls of both sides the threshold is 0. Repeated rows
    are judged alike; an empty table gives no rows; other columns are not read.
    """
    pages = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"))
    scores = score_urls(distinct_urls(pages, rules))
    threshold = calibrated_threshold(scores)
    host, path = url_parts(F.col("url"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    scored = pages.join(scores.select("url", "score"), "url").select("page_id", host.alias("host"), path.alias("path"), "score")
    ruled = scored.select("*", rule.alias("rule"), verdict.alias("_ruled"))
    decided = F.coalesce("_ruled", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return ruled.select("page_id", "host", "path", "rule", decided.alias("verdict"), "score")
