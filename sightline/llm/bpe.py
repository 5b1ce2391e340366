"""Byte-level BPE by monoid tree reduction.

A text is split in halves down to leaves, the leaves are encoded by the library, and neighbours are
joined: the text around the seam is encoded anew in a window that grows to both sides until the
tokens outside it are proven to be those of the whole text. The proof rests on the splitting
pattern: a piece is white space alone, or characters other than white space after at most one space. So
white space behind another character always starts a piece, whatever stands before or follows, and
the pattern looks at nothing left of a piece's start. A window reaches from the last such place of the
left side to the first one of the right side. A side without one is encoded anew whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from sightline.llm.common import ready

LEAF = 2048  # characters
STEP = 64  # first width of a window on either side of a seam
Node = tuple[str, list[int]]  # a text and its ids


class Codec:
    """Encoder and decoder for a file of ranks and a splitting pattern of the kind described above."""

    def __init__(self, path: str, pattern: str, leaf: int = LEAF):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={}).encode_ordinary
        # By the Unicode property, as the library reads it; Python's own class is wider.
        self.starts = regex.compile(r"(?<=\P{White_Space})\p{White_Space}")
        self.leaf = leaf

    def last_start(self, text: str) -> int:
        """The last place that surely starts a piece, 0 if there is none."""
        width = STEP
        while True:
            begin = max(0, len(text) - width)
            found = [m.start() for m in self.starts.finditer(text, begin)]
            if found or not begin:
                return found[-1] if found else 0
            width *= 2

    def first_start(self, text: str) -> int:
        """The first place that surely starts a piece, the end if there is none."""
        found = self.starts.search(text)
        return found.start() if found else len(text)

    def aligned(self, ids: Iterable[int], size: int) -> int:
        """How many of ``ids`` make up ``size`` bytes; a piece boundary is always a token boundary."""
        n = 0
        for i in ids:
            if not size:
                break
            size -= len(self.bytes_of[i])
            n += 1
        return n

    def join(self, left: Node, right: Node) -> Node:
        """The node of the concatenated text."""
        a, b = self.last_start(left[0]), self.first_start(right[0])
        seam = left[0][a:] + right[0][:b]
        drop = self.aligned(reversed(left[1]), len(left[0][a:].encode()))
        skip = self.aligned(right[1], len(right[0][:b].encode()))
        return left[0] + right[0], left[1][: len(left[1]) - drop] + self.library(seam) + right[1][skip:]

    def node(self, text: str) -> Node:
        if len(text) <= self.leaf:
            return text, self.library(text)
        half = len(text) // 2
        return self.join(self.node(text[:half]), self.node(text[half:]))

    def encode(self, text: str | None) -> np.ndarray:
        return np.array(self.node(text)[1] if text else [], np.int32)

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids, halves concatenated up the tree."""
        if len(ids) <= self.leaf:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@lru_cache(4)
def codec(path: str, pattern: str, leaf: int = LEAF) -> Codec:
    """One codec per worker process."""
    return Codec(path, pattern, leaf)


def encode_documents(df: DataFrame, path: str, pattern: str, text_col: str = "text", output: str = "token_ids", leaf: int = LEAF) -> DataFrame:
    """``df`` with the token ids of each text, equal to what the library gives for the same ranks and pattern.

    ``path`` names a file of ranks that every executor can read. Null and empty texts give an empty array. A column
    of ``df`` named like ``output`` is replaced, all others are kept.
    """
    ready(df.sparkSession)

    @F.arrow_udf(ArrayType(IntegerType()))
    def encode(texts: pa.Array) -> pa.Array:
        own = codec(path, pattern, leaf)
        return _lists([own.encode(t) for t in texts.to_pylist()])

    # Not to be run a second time inside what is computed from the ids.
    return df.withColumn(output, encode.asNondeterministic()(F.col(text_col)))


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *parts])))


def encode_and_decode(df: DataFrame, path: str, pattern: str, text_col: str = "text", output: str = "coded", leaf: int = LEAF) -> DataFrame:
    """``df`` with a struct ``output``: token_ids of each text, and decoded, the bytes that these ids give, in one pass.

    The same as ``encode_documents`` followed by ``decode_documents``, without sending the ids to and fro.
    """
    ready(df.sparkSession)

    @F.arrow_udf(StructType([StructField("token_ids", ArrayType(IntegerType())), StructField("decoded", BinaryType())]))
    def both(texts: pa.Array) -> pa.Array:
        own = codec(path, pattern, leaf)
        parts = [own.encode(t) for t in texts.to_pylist()]
        back = pa.array([own.decode(p.tolist()) for p in parts], pa.binary())
        return pa.StructArray.from_arrays([_lists(parts), back], ["token_ids", "decoded"])

    return df.withColumn(output, both.asNondeterministic()(F.col(text_col)))


def decode_documents(df: DataFrame, path: str, pattern: str, ids_col: str = "token_ids", output: str = "decoded", leaf: int = LEAF) -> DataFrame:
    """``df`` with the bytes of each array of ids; null counts as empty. An id without a rank is an error."""
    ready(df.sparkSession)

    @F.arrow_udf(BinaryType())
    def decode(ids: pa.Array) -> pa.Array:
        own = codec(path, pattern, leaf)
        return pa.array([own.decode(x or []) for x in ids.to_pylist()], pa.binary())

    return df.withColumn(output, decode(F.col(ids_col)))
