"""Links between texts by the Jaccard similarity of their word shingles.

Candidates come from min-hashes: texts meet under a key if all ROWS least hashes of one of BANDS bands are equal,
which two texts of similarity s do with a chance of 1 - (1 - s^ROWS)^BANDS: 0.99997 at 0.8, more above. Inside a key
group the whole sets of shingles are compared, so every link given is exact. Texts with the same set are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.simhash import shingle_bits, shingle_digests

BANDS, ROWS = 20, 4
AT_ONCE = 4096  # shingles that are hashed in one step
SENT_BYTES = 16 << 20  # of sets in one batch
_ODD = np.random.default_rng(42).integers(1 << 63, size=(2, BANDS * ROWS), dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    return np.unique(np.frombuffer(shingle_digests(text, words), np.uint64))


def node_of(shingles: np.ndarray) -> int:
    """One number for each set; 0 for the empty one."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), 42)).view(np.int64)) if len(shingles) else 0


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """BANDS signed 64-bit keys of a set; an empty set has none."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), AT_ONCE):
        mixed = (shingles[at : at + AT_ONCE, None] ^ _ODD[1]) * _ODD[0]
        mixed ^= mixed >> np.uint64(32)
        mixed *= _ODD[1]
        least = np.minimum(least, mixed.min(0))
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ column) * _STEP
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def with_sketch(rows: DataFrame, words: int, fingerprint_words: int | None = None) -> DataFrame:
    """(row, id, node, keys) of ``rows`` (row, id, text); ``keys`` are the band keys as bytes.

    With ``fingerprint_words`` also the SimHash ``fingerprint`` over shingles of so many words.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            sets = [shingle_set(t, words) for t in texts]
            nodes = pa.array([node_of(s) for s in sets], pa.int64())
            keys = pa.array([band_keys(s).tobytes() for s in sets], pa.binary())
            columns = {"row": batch.column(0), "id": batch.column(1), "node": nodes, "keys": keys}
            if fingerprint_words:
                columns["fingerprint"] = pa.array([shingle_bits(t, fingerprint_words) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = f"row long, id {rows.schema['id'].dataType.simpleString()}, node long, keys binary"
    return rows.mapInArrow(sketch, schema + (", fingerprint long" if fingerprint_words else ""))


def linked(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``sets``: what a set reaches leaves, so dense groups end fast."""
    sizes = np.array([len(s) for s in sets])
    left, pairs = np.arange(len(sets)), []
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            at = front.pop()
            near = left[np.minimum(sizes[left], sizes[at]) >= similarity * np.maximum(sizes[left], sizes[at]) - 1e-9]
            if not len(near):
                continue
            flat = np.concatenate([sets[k] for k in near])
            place = np.minimum(np.searchsorted(sets[at], flat), sizes[at] - 1)
            ends = np.cumsum(sizes[near])
            common = np.add.reduceat((sets[at][place] == flat).astype(np.int64), ends - sizes[near])
            reached = near[common >= similarity * (sizes[near] + sizes[at] - common) - 1e-9]
            pairs += [(at, int(k)) for k in reached]
            front += reached.tolist()
            left = np.setdiff1d(left, reached, assume_unique=True)
    return pairs


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by the first one, in parts that hold whole runs of equal keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(key, key[-1]))
        if last == 0 and (not held or held[-1].column(0)[-1].as_py() == key[0]):
            held.append(batch)
            continue
        yield _columns([*held, batch.slice(0, last)])
        held = [batch.slice(last)]
    if held:
        yield _columns(held)


def _columns(batches: list[pa.RecordBatch]) -> list[np.ndarray]:
    return [c.to_numpy() for c in pa.Table.from_batches(batches).columns]


def similar_links(sketched: DataFrame, rows: DataFrame, words: int, similarity: float) -> DataFrame:
    """Links (a, b) between nodes whose sets of shingles have a Jaccard similarity of ``similarity`` at least.

    ``sketched`` is (row, id, node, keys), ``rows`` is (row, id, text). Of the links of a key group a spanning forest is
    given. A key group is read in one task, with the sets of its texts (8 bytes for each distinct shingle).
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column(1).to_pylist()
            sizes = [len(b) // 8 for b in blobs]
            nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(blobs), np.int64)), pa.array(nodes)], ["key", "node"])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, node in _runs(batches):
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            # Groups of the same texts have the same name, so that they are compared once.
            mixed = node.view(np.uint64) * _STEP
            names = np.repeat(np.add.reduceat(mixed ^ (mixed >> np.uint64(31)), starts).view(np.int64), sizes)
            many = np.repeat(sizes > 1, sizes)
            yield pa.RecordBatch.from_arrays([pa.array(names[many]), pa.array(node[many])], ["name", "node"])

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(part: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], ["name", "node", "shingles"])

        for batch in batches:
            part, size = [], 0
            for node, text, names in zip(*(c.to_pylist() for c in batch.columns)):
                blob = shingle_set(text, words).tobytes()
                for name in names:
                    part.append((name, node, blob))
                    size += len(blob)
                    if size >= SENT_BYTES:
                        yield packed(part)
                        part, size = [], 0
            if part:
                yield packed(part)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, node, shingles in _runs(batches):
            cuts = np.flatnonzero(name[1:] != name[:-1]) + 1
            a, b = [], []
            for part in np.split(np.arange(len(name)), cuts):
                sets = [np.frombuffer(shingles[k], np.uint64) for k in part]
                for x, y in linked(sets, similarity):
                    a.append(node[part[x]]), b.append(node[part[y]])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    nodes = sketched.groupBy("node").agg(F.first("keys").alias("keys"), F.min("row").alias("row"))
    keys = nodes.select("node", "keys").mapInArrow(keyed, "key long, node long")
    met = keys.repartition(F.col("key")).sortWithinPartitions("key").mapInArrow(groups, "name long, node long").distinct()
    # A set is made where its text is and sent to its groups at once; equal rows lie together after the join.
    named = met.join(nodes.select("node", "row"), "node").groupBy("row").agg(F.first("node").alias("node"), F.collect_list("name").alias("names"))
    texts = rows.select("row", "text").join(named, "row").dropDuplicates(["row"]).select("node", "text", "names")
    sets = texts.mapInArrow(shingled, "name long, node long, shingles binary")
    return sets.repartition(F.col("name")).sortWithinPartitions("name").mapInArrow(compared, "a long, b long").distinct()
