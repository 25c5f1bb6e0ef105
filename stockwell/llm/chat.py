"""Chat formatting with typed content parts.

A visitor flattens each turn's text, image, audio and document parts into text with
ordered placeholders, and records every attachment's place, reference and
expanded token count. A turn becomes one segment; a conversation's output is its
segments in order, so no conversation is ever gathered in one row. Control strings
inside texts and roles are broken by an escape that reading back undoes.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
#: Tokens of one image patch side, of a second of audio and of a document page.
PATCH, AUDIO_TOKENS, PAGE_TOKENS = 14, 25, 576
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
_READ = re.compile(r"\\(\\|\.)")


def escaped(text: Column) -> Column:
    r"""``\`` doubled, and ``\.`` after the first character of each control string."""
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, r"([<\[])(?=(?:(?<=<)(?:\||/?s>|</?SYS>>)|(?<=\[)/?INST\]))", r"$1\\.")


def unescaped(text: str) -> str:
    return _READ.sub(lambda m: "\\" if m[1] == "\\" else "", text)


def text_part(text: Column) -> Column:
    """A turn's plain text as its only part."""
    none = [F.lit(None).alias(n) for n in ("ref", "width", "height", "seconds", "pages")]
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *none)).cast(f"array<{PART}>")


def expanded_tokens(part: Column) -> Column:
    """Tokens a placeholder stands for: patches, seconds or pages; at least one."""
    patches = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
    count = (
        F.when(part["type"] == "image", patches)
        .when(part["type"] == "audio", F.ceil(part["seconds"] * AUDIO_TOKENS))
        .when(part["type"] == "document", part["pages"] * PAGE_TOKENS)
    )
    return F.greatest(F.coalesce(count, F.lit(1)), F.lit(1)).cast("bigint")


def format_turns(turns: DataFrame, parts_col: str = "parts") -> DataFrame:
    """Segments ``conv_id, turn, role, segment, loss_start, loss_end, attachments, n_expanded``.

    ``loss_start`` and ``loss_end`` bound an assistant's content within its segment
    in code points; other roles have no loss span. A null role, text or part list is
    empty; a part of another type is an attachment of one token. Rows are
    formatted on their own, so repeats and ties need no rule; other columns are dropped.
    """
    parts = F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>"))
    parts = F.filter(parts, F.isnotnull)

    def visit(part):
        kind = escaped(F.coalesce(part["type"], F.lit("unknown")))
        return F.when(part["type"] == "text", escaped(part["text"])).otherwise(F.concat(F.lit("<|"), kind, F.lit("|>")))

    content = F.array_join(F.transform(parts, visit), "")
    attached = F.filter(parts, lambda p: ~p["type"].eqNullSafe(F.lit("text")))
    attachments = F.transform(
        attached,
        lambda p, i: F.struct(i.alias("place"), p["type"].alias("type"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")),
    )
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(SAYS))
    flat = turns.select(
        "conv_id", "turn", "role", head.alias("_head"), content.alias("_content"), attachments.alias("attachments")
    )
    learned = F.col("role").eqNullSafe(F.lit("assistant"))
    start = F.length("_head").cast("bigint")
    return flat.select(
        "conv_id",
        "turn",
        "role",
        F.concat("_head", "_content", F.lit(END)).alias("segment"),
        F.when(learned, start).alias("loss_start"),
        F.when(learned, start + F.length("_content")).alias("loss_end"),
        "attachments",
        F.aggregate("attachments", F.lit(0).cast("bigint"), lambda acc, a: acc + a["tokens"]).alias("n_expanded"),
    )


def read_back(segments: DataFrame) -> DataFrame:
    """One row per conversation, parsed from its formatted output.

    Segments stream in order of turn, then role and segment (nulls first), each through
    running digests: a task holds one batch, however long a conversation is. A null
    ``conv_id`` is one conversation. Repeated rows are turns of their own.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def parse(batches):
        now, state = None, None

        def row():
            return (now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for batch in batches:
            done = []
            for conv, segment, start, end in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if now != (conv,):
                    if now is not None:
                        done.append(row())
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, content = segment.removeprefix(TURN).removesuffix(END).split(SAYS, 1)
                state[0] += 1
                state[1].update(f"{unescaped(role)}\n{unescaped(content)}\n".encode("utf-8", "surrogatepass"))
                if start is not None:
                    learned = unescaped(segment[start:end])
                    state[2] += len(learned)
                    state[3].update(learned.encode("utf-8", "surrogatepass"))
                state[4] += len(segment)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done) if done else ((),) * 6, types)], names=names
            )
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row(), types)], names=names)

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "segment")
    return ordered.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(
        parse,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
