"""Positions of regular-expression matches as column expressions.

Spark has no function that returns where matches stand. Splitting a text at
its matches gives the gaps, extracting them gives the matches, and running sums
of both lengths give every start and end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values summed at a time; keeps running sums from copying long arrays.
_CHUNK = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used inside."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _appended_sums(values: Column) -> Column:
    """Sums of all values before each one, for a short array."""
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("seen"))
    return F.aggregate(
        values,
        start,
        lambda acc, v: F.struct((acc["sum"] + v).alias("sum"), F.concat(acc["seen"], F.array(acc["sum"])).alias("seen")),
        lambda acc: acc["seen"],
    )


def in_chunks(values: Column) -> Column:
    """An array as an array of chunks; one empty chunk for an empty array."""
    def chunked(v):
        count = F.greatest(F.lit(0), F.floor((F.size(v) - 1) / _CHUNK).cast("int"))
        return F.transform(F.sequence(F.lit(0), count), lambda i: F.slice(v, i * _CHUNK + 1, F.lit(_CHUNK)))

    return let(values, chunked)


def sums_before(values: Column) -> Column:
    """For each value of a ``array<bigint>`` the sum of the values before it."""
    def placed(chunks):
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda acc, v: acc + v))
        return F.flatten(
            F.zip_with(
                chunks,
                _appended_sums(totals),
                lambda c, before: F.transform(_appended_sums(c), lambda s: s + before),
            )
        )

    return let(in_chunks(values), placed)


def match_spans(
    text: Column,
    pattern: Column,
    length_of_gap: Callable[[Column], Column] = F.length,
    length_of_match: Callable[[Column], Column] = F.length,
) -> Column:
    """``array<struct<start, end, match>>`` of all leftmost non-overlapping matches.

    Lengths are code points unless other measures are given. The pattern must
    not match empty text.
    """
    def placed(found):
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        lengths = F.zip_with(
            gaps,
            found,
            lambda g, m: F.struct(
                length_of_gap(g).cast("long").alias("gap"), length_of_match(m).cast("long").alias("own"), m.alias("match")
            ),
        )
        return let(lengths, spanned)

    def spanned(lengths):
        return F.zip_with(
            sums_before(F.transform(lengths, lambda x: x["gap"] + x["own"])),
            lengths,
            lambda before, x: F.struct(
                (before + x["gap"]).alias("start"), (before + x["gap"] + x["own"]).alias("end"), x["match"].alias("match")
            ),
        )

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), placed)
