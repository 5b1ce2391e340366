"""Near duplicates by SimHash fingerprints, found through Golay-code keys.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits, each padded with zeros to a word of
the perfect binary Golay code [23, 12, 7]. Every 23-bit word has one codeword within distance 3, and
some words have five more at distance 4. If two words differ in at most one bit, the nearest
codeword of the one lies within distance 4 of the other. So with "index" keys from the nearest
codeword and "search" keys from all codewords within distance 4, an error in a segment is forgiven.

Three or fewer differing bits spread over three segments in one of two ways:

* some segment is free of errors and some other has at most one: key = (exact segment, Golay index),
  six ordered pairs of segments;
* each segment has exactly one: key = (Golay index, Golay index, Golay index).

Hence two fingerprints that link always meet under a key, where they are verified by their bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from sightline.llm.common import connected_components, cut_lineage, ready, unused_name

SEGMENTS = ((42, 22), (21, 21), (0, 21))  # (shift, bits), together 64 bits
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, fixed value of the code
SMALL = 12  # groups up to this size are compared pair by pair, larger ones by spreading links


def shingle_digests(text: str | None, words: int) -> bytes:
    """XXH64 (seed 42) of each word shingle, 8 bytes each; a text of fewer words is one shingle, one without words has none."""
    tokens = text.encode().lower().split() if text else []
    if not tokens:
        return b""
    line = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_digest(line, 42)
    ends = list(accumulate(len(t) + 1 for t in tokens))
    digest = xxhash.xxh64_digest
    starts = [0, *ends]
    return b"".join([digest(line[a : b - 1], 42) for a, b in zip(starts, ends[words - 1 :])])


def shingle_bits(text: str | None, words: int = 3) -> int:
    """SimHash of a text: majority bits of XXH64 (seed 42) over word shingles, as a signed 64-bit value."""
    hashes = shingle_digests(text, words)
    if not hashes:
        return 0
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    top = bits.sum(0, dtype=np.int64) * 2 > len(bits)
    return int(np.packbits(top).view(">i8")[0])


def fingerprints(df: DataFrame, text_col: str = "text", words: int = 3) -> DataFrame:
    """``df`` with the signed 64-bit ``fingerprint`` of a text; null or wordless texts have 0."""

    @F.pandas_udf(LongType())
    def _fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shingle_bits(t, words) for t in batch], dtype="int64")

    return df.withColumn("fingerprint", _fingerprint(F.col(text_col)))


@lru_cache(1)
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per 23-bit syndrome (11 bits): the leader, and the flips to all codewords within distance 4, padded with -1.

    Built from the generator polynomial; a syndrome is the remainder of the word.
    """
    one = np.zeros(23, np.int64)  # syndrome of each single bit
    for bit in range(23):
        r = 1 << bit
        for k in range(22, 10, -1):
            if r >> k & 1:
                r ^= GENERATOR << (k - 11)
        one[bit] = r
    flips: list[list[int]] = [[] for _ in range(2048)]
    patterns, syndromes, last = np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(1, -1)
    for _ in range(5):
        for p, s in zip(patterns.tolist(), syndromes.tolist()):
            flips[s].append(p)
        grown = [(np.where(last < b)[0], b) for b in range(23)]
        patterns, syndromes, last = (
            np.concatenate([patterns[i] | 1 << b for i, b in grown]),
            np.concatenate([syndromes[i] ^ one[b] for i, b in grown]),
            np.concatenate([np.full(len(i), b) for i, b in grown]),
        )
    width = max(map(len, flips))
    table = np.full((2048, width), -1, np.int64)
    for s, f in enumerate(flips):
        table[s, : len(f)] = f
    low = np.zeros(1 << 12, np.int64)  # remainders of the upper and lower half of a word
    high = np.zeros(1 << 11, np.int64)
    for bit in range(12):
        low[np.arange(1 << 12) >> bit & 1 == 1] ^= one[bit]
    for bit in range(11):
        high[np.arange(1 << 11) >> bit & 1 == 1] ^= one[12 + bit]
    return table, low, high


def golay_indices(words: np.ndarray) -> np.ndarray:
    """Codeword indices (12 bits) within distance 4 of each 23-bit word, nearest first, -1 for none."""
    table, low, high = golay_tables()
    flips = table[low[words & 4095] ^ high[words >> 12]]
    return np.where(flips >= 0, (words[:, None] ^ flips) >> 11, -1)  # systematic: the upper 12 bits name a codeword


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, position in ``prints``, is an index key) for every key of the fingerprints."""
    prints = prints.view(np.uint64)
    exact = [(prints >> np.uint64(s) & np.uint64((1 << b) - 1)).astype(np.int64) for s, b in SEGMENTS]
    near = [golay_indices(e) for e in exact]
    rows = np.arange(len(prints))
    out = []

    def emit(tag: int, value: np.ndarray, valid: np.ndarray, first: np.ndarray) -> None:
        pos = np.broadcast_to(rows.reshape(-1, *[1] * (value.ndim - 1)), value.shape)[valid]
        out.append(((value[valid] << 3) | tag, pos, np.broadcast_to(first, value.shape)[valid]))

    tag = 0
    for a in range(3):
        for b in range(3):
            if a != b:
                emit(tag, exact[a][:, None] << 12 | near[b], near[b] >= 0, np.arange(near[b].shape[1])[None] == 0)
                tag += 1
    x, y, z = near[0][:, :, None, None], near[1][:, None, :, None], near[2][:, None, None, :]
    first = np.zeros((1, x.shape[1], y.shape[2], z.shape[3]), bool)
    first[0, 0, 0, 0] = True
    emit(tag, x << 24 | y << 12 | z, (x >= 0) & (y >= 0) & (z >= 0), first)
    return tuple(np.concatenate([o[k] for o in out]) for k in range(3))


def _linked(prints: np.ndarray, index: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside one group: reached members leave, so dense groups end fast."""
    left, tails, heads = np.arange(len(prints)), [], []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            at, front = front[0], front[1:]
            hit = np.bitwise_count(prints[left] ^ prints[at]) <= bits
            if hit.any():
                reached = left[hit]
                tails.append(np.full(len(reached), at))
                heads.append(reached)
                front, left = np.concatenate([front, reached]), left[~hit]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *tails]), np.concatenate([none, *heads])


def links_of_sorted(keys: np.ndarray, prints: np.ndarray, index: np.ndarray, bits: int) -> np.ndarray:
    """Verified links (pairs of fingerprints) within runs of equal keys."""
    prints = prints.view(np.uint64)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    size = np.repeat(sizes, sizes)
    pairs = []
    small = size <= SMALL
    for step in range(1, SMALL):
        at = np.flatnonzero(small[:-step] & (keys[:-step] == keys[step:]))
        if not len(at):
            break
        at = at[(index[at] | index[at + step]) & (np.bitwise_count(prints[at] ^ prints[at + step]) <= bits)]
        pairs.append(np.stack([prints[at], prints[at + step]], 1))
    for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        if index[s : s + n].any():
            tails, heads = _linked(prints[s : s + n], index[s : s + n], bits)
            pairs.append(np.stack([prints[s + tails], prints[s + heads]], 1))
    if not pairs:
        return np.zeros((0, 2), np.int64)
    found = np.sort(np.concatenate(pairs), axis=1)
    return np.unique(found, axis=0).view(np.int64)


def simhash_links(prints: DataFrame, bits: int = 3) -> DataFrame:
    """Links (a, b) between distinct ``fingerprint`` values at ``bits`` (at most 3) or fewer differing bits.

    Not every linked pair is listed: within a key group larger than a dozen a spanning forest of its
    links is, which has the same components. Keys are spread by hash, read in key order and compared
    in numpy, with one key group in memory at a time (8 bytes for each distinct fingerprint).
    """
    if not 0 <= bits <= 3:
        raise ValueError("the Golay keys forgive three bits at most")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(values), 250):
                part = values[at : at + 250]
                key, pos, first = golay_keys(part)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[pos]), pa.array(first)], ["key", "fp", "first"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            key, fp, first = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            if last == 0 and (not held or held[-1][0][-1] == key[0]):
                held.append((key, fp, first))
                continue
            held.append((key[:last], fp[:last], first[:last]))
            pairs = links_of_sorted(*(np.concatenate([h[k] for h in held]) for k in range(3)), bits)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
            held = [(key[last:], fp[last:], first[last:])]
        if held:
            pairs = links_of_sorted(*(np.concatenate([h[k] for h in held]) for k in range(3)), bits)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    keys = prints.select("fingerprint").distinct().mapInArrow(keyed, "key long, fp long, first boolean")
    met = keys.repartition(F.col("key")).sortWithinPartitions("key")
    return met.mapInArrow(linked, "a long, b long").distinct()


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 3) -> DataFrame:
    """(``id_col``, fingerprint as signed long, component_id) for every row of ``df``.

    The component is the smallest id reachable over fingerprints at ``bits`` or fewer differing bits.
    Equal fingerprints are one node whatever their number. Null, empty and wordless texts have
    fingerprint 0 and link like any other. Repeated rows stay repeated; a null id never names a
    component unless its whole component has none. Columns other than these two are not read.
    """
    spark = ready(df.sparkSession)
    prints = cut_lineage(fingerprints(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).select("id", "fingerprint"))
    nodes = prints.groupBy("fingerprint").agg(F.min("id").alias("least"))
    roots = connected_components(simhash_links(nodes, bits))
    named = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    component = named.join(least, "root").select("fingerprint", "component_id")
    return prints.join(component, "fingerprint").select(F.col("id").alias(id_col), "fingerprint", "component_id")


def fingerprint_links(sketched: DataFrame, bits: int) -> DataFrame:
    """Links (a, b) between nodes of ``sketched`` (node, fingerprint, ...) that hold fingerprints at ``bits`` or fewer differing bits.

    The least node of a fingerprint stands for it. Links are fixed by a checkpoint, so that the keys are made once.
    """
    held = sketched.select("node", "fingerprint").distinct()
    prints = cut_lineage(held.groupBy("fingerprint").agg(F.min("node").alias("named")))
    same = held.join(prints, "fingerprint").select(F.col("named").alias("a"), F.col("node").alias("b"))
    near = simhash_links(prints, bits)
    for end in ("a", "b"):
        near = near.join(prints.select(F.col("fingerprint").alias(end), F.col("named").alias(f"_{end}")), end)
    return cut_lineage(same.union(near.select(F.col("_a").alias("a"), F.col("_b").alias("b"))).where("a <> b").distinct())


def keep_one(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 3, words: int = 3, similarity: float | None = None,
    fingerprint_words: int | None = None,
) -> DataFrame:
    """One row of each component of near copies, all columns kept.

    Without ``similarity``, texts link at ``bits`` or fewer differing bits of the fingerprint over ``words``-word shingles.
    With it, they link if the Jaccard similarity of their sets of ``words``-word shingles is at least so large
    (``resemblance.py``); with ``fingerprint_words`` too, also at ``bits`` or fewer differing bits of the fingerprint over shingles
    of so many words, and a component holds the links of both kinds. Without it ``bits`` is not used.
    The row of least id stays, an id before none, then the least hash of the text. Rows with the same id and text
    collapse to one. Rows are told apart by a hash of id and text, so nothing depends on ids being unique or there.
    """
    from sightline.llm.resemblance import similar_links, with_sketch

    ready(df.sparkSession)
    key = unused_name(df, "_row")
    row = F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.col(text_col).isNull(), F.col(text_col))
    rows = df.select(row.alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if similarity is None:
        sketched = fingerprints(rows, words=words).select("row", "id", F.col("fingerprint").alias("node"))
    else:
        sketched = with_sketch(rows, words, fingerprint_words)
    sketched = cut_lineage(sketched)
    named_by = F.min(F.struct(F.col("id").isNull().alias("bare"), "id", "row")).alias("least")
    nodes = sketched.groupBy("node").agg(named_by)
    if similarity is None:
        links = simhash_links(nodes.select(F.col("node").alias("fingerprint")), bits)
    else:
        alike = fingerprint_links(sketched, bits) if fingerprint_words else None
        links = similar_links(sketched, rows, words, similarity)
        links = links if alike is None else links.union(alike)
    roots = connected_components(links)
    named = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    stay = named.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.row").alias(key))
    return df.withColumn(key, row).join(stay, key, "left_semi").dropDuplicates([key]).drop(key)


def hex_digits(column: str) -> F.Column:
    """A signed 64-bit value as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
