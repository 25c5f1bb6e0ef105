"""Packing token sequences with first-fit decreasing in randomised groups.

Stage one tokenizes each whole document where it is read and cuts it into pieces:
full sequences, then a half sequence if more than half is left, then the
remainder. Items of at most half a bin are what first-fit decreasing packs
almost without loss. Stage two deals the pieces to groups by a hash of the id, the
start and a salt written with the piece, and packs each group on its own, so groups run in parallel and a lost one is redone
alone. Only lengths and checksums are shuffled.
"""

from __future__ import annotations

import base64
import functools
import math
import zlib
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwell.llm.common import tokenizer_file, whole_text, written
from stockwell.llm.tournament import first_fit_decreasing

CAPACITY = 1024
#: Documents of one group; a group's pieces are packed by one task.
GROUP_DOCUMENTS = 4096
END = 0
SALT = "_salt"


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Whole-text token ids as little-endian unsigned 32-bit numbers.

    The same vocabulary in its rank form merges several times faster and gives
    the same ids. The tokenizer itself takes the texts that hold a special token's
    string, which it knows, and those the rank form cannot encode: its regular
    expression gives up on about a million white-space characters in a row.
    """

    def __init__(self, path: str, ranks: str, specials: list[str]):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.path, self.specials = path, specials

    @functools.cached_property
    def tokenizer(self):
        """Loaded where a text needs it: it takes as much memory as the rank form."""
        return _tokenizer(self.path)

    def encode(self, text: str) -> bytes:
        if not any(s in text for s in self.specials):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
            except ValueError:
                pass
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    pieces = [(s, capacity) for s in range(0, length - capacity + 1, capacity)]
    start = len(pieces) * capacity
    if length - start > capacity // 2:
        pieces.append((start, capacity // 2))
        start += capacity // 2
    if length > start:
        pieces.append((start, length - start))
    return pieces


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    ranks: str | None = None,
    capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids``) per piece.

    ``tokenizer`` and ``ranks`` are the paths of the same vocabulary in its two forms.
    """
    path, ranks = tokenizer or tokenizer_file(), ranks or tokenizer_file("byte_bpe_50k.tiktoken")
    specials = [t.content for t in _tokenizer(path).get_added_tokens_decoder().values()]
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids

    def pieces(batches):
        encoder = Encoder(path, ranks, specials)
        end = np.asarray([END], "<u4").tobytes()
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py()) + end
                for start, length in cut(len(ids) // 4, capacity):
                    piece = ids[4 * start : 4 * (start + length)]
                    row = [doc_id, start, length, zlib.crc32(piece), len(ids) // 4]
                    if keep_ids:
                        row.append(np.frombuffer(piece, "<u4"))
                    for column, value in zip(columns, row):
                        column.append(value)
            types = [pa.int64()] * 5 + [pa.list_(pa.int64())] * keep_ids
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return source.mapInArrow(pieces, schema + (", ids array<long>" if keep_ids else ""))


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_documents: int = GROUP_DOCUMENTS) -> DataFrame:
    """Add ``sequence_id`` and ``offset``; sequences are filled from offset 0 without gaps.

    Groups are dealt by a hash of ``doc_id``, ``start`` and, if there, ``_salt``, which is
    dropped; their number follows that of documents and, where documents are long, that of pieces,
    so a group holds about four times ``group_documents`` pieces at most. With a salt of its own for each piece no repeated or null id fills a group.
    """
    size = pieces.agg(F.count_if(F.col("start") == 0).alias("documents"), F.count(F.lit(1)).alias("pieces")).first()
    groups = max(1, math.ceil(size["documents"] / group_documents), math.ceil(size["pieces"] / (4 * group_documents)))
    names = [c for c in pieces.columns if c != SALT]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields if f.name != SALT)

    def pack_group(key: tuple[Any, ...], group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "start", "length"], kind="stable", ignore_index=True)
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), capacity)
        return group[names].assign(sequence_id=(key[0] << 32) + bins, offset=offsets)

    keys = ["doc_id", "start"] + [SALT] * (SALT in pieces.columns)
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(*keys), F.lit(groups))).drop(SALT)
    return dealt.groupBy("_group").applyInPandas(pack_group, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Tokenize, cut and pack whole documents; one row per piece.

    A null or empty text is the end id alone. Rows that repeat an id are documents of
    their own with equal pieces. A null id is packed like any other. An empty table
    gives no rows; other columns are not read.
    """
    packing = {k: options.pop(k) for k in ("capacity", "group_documents") if k in options}
    cutting = {k: v for k, v in packing.items() if k == "capacity"}
    cut_up = token_pieces(docs, id_col, text_col, **options, **cutting)
    pieces = written(cut_up.withColumn(SALT, F.monotonically_increasing_id()), "pieces")
    return pack(pieces, **packing)
