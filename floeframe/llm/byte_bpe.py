"""Byte-level BPE encoding and decoding over Arrow batches.

`encoded` gives each row's ids and, on request, the character where each token begins; `decoded` turns ids back
into bytes through the reversed byte table and into text, where a character split over several tokens becomes
whole again and one that stays split at an end becomes U+FFFD. `round_trip` is the digest form of both.

Null text counts as empty, an empty text has no ids; repeated rows give repeated results; an empty table gives an
empty one; other columns play no part. Null ids decode to the empty text, ids outside the vocabulary raise.
"""

from __future__ import annotations

import functools
import hashlib
import json
import sys
from array import array

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from floeframe.llm.common import arrow_map, ids_and_text
from floeframe.llm.tokenize import LETTERS, byte_encoder


@functools.cache
def byte_table(path: str) -> list[bytes]:
    """id -> its bytes: the vocabulary's letters back through the byte table."""
    back = {letter: byte for byte, letter in LETTERS.items()}
    with open(path, encoding="utf-8") as file:
        saved = json.load(file)
    names = saved["model"]["vocab"] | {x["content"]: x["id"] for x in saved["added_tokens"]}
    table = [b""] * (max(names.values()) + 1)
    for name, i in names.items():
        table[i] = bytes(map(back.__getitem__, name)) if all(c in back for c in name) else name.encode()
    return table


def as_ids(packed: bytes) -> array:
    ids = array("I", packed)
    if sys.byteorder == "big":
        ids.byteswap()
    return ids


def starts(text: str, pieces: list[bytes]) -> list[int]:
    """Where each token begins, in characters; a token that begins inside a character counts that character."""
    out, at = [], 0
    for piece in pieces:
        inside = bool(piece) and 0x80 <= piece[0] < 0xC0
        out.append(at - inside)
        at += sum(not 0x80 <= b < 0xC0 for b in piece)
    return out


def encoded(docs: DataFrame, vocabulary: str, pattern: str, offsets: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>[, offsets array<int>]) of every row of docs."""
    fields = [StructField(id_col, LongType()), StructField("ids", ArrayType(IntegerType()))]
    schema = StructType(fields + [StructField("offsets", ArrayType(IntegerType()))] * offsets)

    def columns(batch):
        encode, table = byte_encoder(vocabulary, pattern), byte_table(vocabulary)
        texts = batch.column(1).to_pylist()
        ids = [as_ids(encode(t)).tolist() for t in texts]
        made = [batch.column(0), ids]
        return made + [[starts(t, [table[i] for i in x]) for t, x in zip(texts, ids)]] if offsets else made

    return arrow_map(ids_and_text(docs, id_col, text_col), columns, schema)


def decoded(rows: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, bytes binary, text string) of rows of ids."""
    schema = StructType([StructField(id_col, LongType()), StructField("bytes", BinaryType()), StructField("text", StringType())])

    def columns(batch):
        piece = byte_table(vocabulary).__getitem__
        data = [b"".join(map(piece, ids or ())) for ids in batch.column(1).to_pylist()]
        return [batch.column(0), data, [x.decode("utf-8", "replace") for x in data]]

    return arrow_map(rows.select(rows[id_col].cast("long"), rows[ids_col]), columns, schema)


DIGESTS = StructType([StructField("doc_id", LongType()), StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])


def round_trip(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode each text, decode the ids, digest both. One narrow stage."""

    def columns(batch):
        encode, piece = byte_encoder(vocabulary, pattern), byte_table(vocabulary).__getitem__
        counts, ids_digests, bytes_digests = [], [], []
        for text in batch.column(1).to_pylist():
            packed = encode(text)
            data = b"".join(map(piece, as_ids(packed)))
            counts.append(len(packed) // 4)
            ids_digests.append(hashlib.sha256(packed).hexdigest())
            bytes_digests.append(hashlib.sha256(data).hexdigest())
        return [batch.column(0), counts, ids_digests, bytes_digests]

    return arrow_map(ids_and_text(docs), columns, DIGESTS)
