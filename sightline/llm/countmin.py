"""Repeated word windows across documents, found through a count-min sketch dealt over many tasks.

Documents are dealt to groups of bounded size. Each group counts its windows in a sparse sketch of its own: for every row of
the sketch the cells its windows fall into, each with one or several documents. The sketches are merged slice by slice, a slice
being a stretch of cells with a bounded load, and each group gets back one bit for each cell it sent: do several
documents share it. A window all of whose cells are shared is only *estimated* to be repeated. Those windows alone are
grouped exactly, by 128-bit keys with their least document, and a second bit comes back: does a smaller document
hold it. Cells overestimate, so no repeated window is lost; what is estimated wrongly finds no partner.

Groups, slices and key parts grow with the input while what one of them holds does not. Nothing is broadcast or read
by the driver but one byte total. A window that a third of all documents hold comes once from each group, however often it stands there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from sightline.llm.common import ready

GROUP_BYTES = 4 << 20  # text of a group of documents
SLICE_BYTES = 16 << 20  # text whose windows load one slice of a row of the sketch
PART_BYTES = 16 << 20  # text whose windows, if all repeated, make up a part of the exact grouping
CELL_BITS = 25  # cells of a slice: a load of about a twelfth
ROWS = 2  # of the sketch

MULTIPLIERS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MULTIPLIERS[2]
    return h ^ (h >> np.uint64(29))


def joined(a: np.ndarray, b: np.ndarray, lane: int) -> np.ndarray:
    """Key of a stretch made of two shorter ones."""
    return mix(a * MULTIPLIERS[lane] + b * MULTIPLIERS[3 - lane] + np.uint64(lane))


def window_keys(words: np.ndarray, width: int, lane: int) -> np.ndarray:
    """Key of the ``width`` words from each place on: stretches of 1, 2, 4, ... words joined, the last two overlapping."""
    size = 1
    while 2 * size <= width:
        words = joined(words[: len(words) - size], words[size:], lane) if len(words) > size else words[:0]
        size *= 2
    if size < width:
        shift = width - size
        words = joined(words[: len(words) - shift], words[shift:], lane) if len(words) > shift else words[:0]
    return words


class _Numbers(dict):
    """Numbers of words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Group:
    """Documents with an id, in order of it, and the keys of their windows; the same for the same rows, whoever builds it."""

    def __init__(self, docs: pa.Table, width: int):
        rows = zip(docs.column("id").to_pylist(), docs.column("text").to_pylist())
        known = sorted((i, k, (t or b"").split()) for k, (i, t) in enumerate(rows) if i is not None)
        self.places = [k for _, k, _ in known]  # rows in ``docs``
        self.words = [w for _, _, w in known]
        self.width = width
        number = _Numbers()
        which = np.fromiter((number[w] for words in self.words for w in words), np.int64)
        digest = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, number)), np.uint64).reshape(-1, 2)
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        starts = np.maximum(self.sizes - width + 1, 0)
        #: Windows in order of id: row of the document, id, place of the first word among all words.
        self.doc = np.repeat(np.arange(len(known)), starts)
        self.id = np.array([i for i, _, _ in known], np.int64)[self.doc]
        self.at = np.arange(len(self.doc)) - np.repeat(np.cumsum(starts) - starts, starts) + self.begin[self.doc]
        self.lanes = [window_keys(digest[which, lane], width, lane)[self.at] for lane in range(2)] if len(self.at) else [np.zeros(0, np.uint64)] * 2

    def counted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, several, which) of the distinct first keys: held by several ids; ``which`` leads from windows to them."""
        order = np.argsort(self.lanes[0], kind="stable")
        keys = self.lanes[0][order]
        head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        tail = np.r_[head[1:] - 1, len(keys) - 1][: len(head)]
        which = np.empty(len(keys), np.int64)
        which[order] = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(keys)]))
        ids = self.id[order]
        return keys[head], ids[head] != ids[tail], which


def dealt(number: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(number, places) for each distinct number."""
    order = np.argsort(number, kind="stable")
    cuts = np.flatnonzero(np.diff(number[order])) + 1
    return [(int(number[p[0]]), p) for p in np.split(order, cuts)] if len(order) else []


def cells(keys: np.ndarray, row: int, slices: int) -> tuple[np.ndarray, np.ndarray]:
    """(slice, cell) of each key in a row of the sketch."""
    h = mix(keys + np.uint64(0x9E3779B97F4A7C15 * (row + 1) % (1 << 64)))
    return ((h >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64) + row * slices, (h & np.uint64((1 << CELL_BITS) - 1)).astype(np.uint32)


def packed(cell: np.ndarray) -> bytes:
    """Rising cells as steps, byte by byte of all of them: the upper bytes are almost all zero, and the shuffle's compression drops them."""
    return np.ascontiguousarray(np.diff(cell, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T).tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T).view(np.uint32).ravel(), dtype=np.uint32)


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def remove_repeated_windows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, rows: int = ROWS) -> DataFrame:
    """Take out every word covered by a ``width``-word window that also starts in a document with a smaller id.

    Words are runs of characters other than space and U+0009 to U+000D, unchanged. Returns ``id_col``, n_words, n_removed, removed (array of
    start and end of the maximal removed runs, in words) and kept (the remaining words, joined by a space), one row per row of ``df``;
    other columns are not read. Windows never cross documents and are judged on the input. Texts that are null or blank have no
    words; shorter texts than ``width`` words are kept. Rows of one id do not match each other, rows with a null id match nothing. Ids
    are integers, any other type is an error. ``rows`` is the depth of the sketch; it changes the cost, never the result.
    """
    if width < 1 or rows < 1:
        raise ValueError("width and rows must be at least 1")
    kind = df.schema[id_col].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"{id_col} must be an integer column, not {kind.simpleString()}")
    ready(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups, slices, parts = (max(1, -(-total // size)) for size in (GROUP_BYTES, SLICE_BYTES, PART_BYTES))
    docs = docs.withColumn("g", F.pmod(F.xxhash64("id", "text"), F.lit(groups)))

    def sliced(keys: np.ndarray):
        """(slice, places in ``keys``, cells) of all rows of the sketch, always in the same order, cells rising."""
        for row in range(rows):
            where, cell = cells(keys, row, slices)
            rising = np.argsort(cell, kind="stable")
            for number, places in dealt(where[rising]):
                yield number, rising[places], cell[rising[places]]

    def own_sketch(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        found, several, _ = Group(group, width).counted()
        sent = [(number, key[0].as_py(), packed(cell), bits(several[places])) for number, places, cell in sliced(found)]
        return pa.Table.from_pylist([dict(zip(("part", "g", "cells", "several"), s)) for s in sent], ASKED)

    def merged(key: tuple[pa.Scalar, ...], slice_: pa.Table) -> pa.Table:
        sent = [unpacked(x) for x in slice_.column("cells").to_pylist()]
        count = np.zeros(1 << CELL_BITS, np.uint8)
        for cell, several in zip(sent, slice_.column("several").to_pylist()):
            twice = flags(several, len(cell))
            held = count[cell]
            count[cell] = 1
            # Two windows of one group may share a cell: whatever was or becomes two stays two.
            count[cell[twice | (held > 0)]] = 2
            count[cell[1:][cell[1:] == cell[:-1]]] = 2
        return _answer(key[0].as_py(), 0, slice_.column("g"), [bits(count[cell] > 1) for cell in sent])

    def estimated(own: Group, answers: pa.Table) -> np.ndarray:
        """Windows that the sketch takes for repeated."""
        found, _, which = own.counted()
        bit = _by_part(answers, 0)
        passed = np.ones(len(found), bool)
        for number, places, _ in sliced(found):
            passed[places] &= flags(bit[number], len(places))
        return np.flatnonzero(passed[which]) if len(which) else which

    def distinct(own: Group, windows: np.ndarray):
        """The windows in order of (keys, id), and where each distinct one begins."""
        order = windows[np.lexsort((own.lanes[1][windows], own.lanes[0][windows]))]
        a, b = own.lanes[0][order], own.lanes[1][order]
        head = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(order) else np.zeros(0, np.int64)
        return order, head, [(n, p) for n, p in dealt((own.lanes[1][order[head]] % np.uint64(parts)).astype(np.int64))]

    def ask(key: tuple[pa.Scalar, ...], group: pa.Table, answers: pa.Table) -> pa.Table:
        own = Group(group, width)
        order, head, by_part = distinct(own, estimated(own, answers))
        first = order[head]
        sent = [dict(part=n, g=key[0].as_py(), keys=np.stack([lane[first[p]] for lane in own.lanes], 1).tobytes(), least=own.id[first[p]].tobytes()) for n, p in by_part]
        return pa.Table.from_pylist(sent, KEYED)

    def least(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(part.column("keys").to_pylist()), np.uint64).reshape(-1, 2)
        ids = [np.frombuffer(x, np.int64) for x in part.column("least").to_pylist()]
        own = np.concatenate(ids)
        order = np.lexsort((own, keys[:, 1], keys[:, 0]))
        head = np.r_[True, (keys[order[1:]] != keys[order[:-1]]).any(1)]
        smallest = np.empty(len(own), np.int64)
        smallest[order] = own[order[np.flatnonzero(head)[np.cumsum(head) - 1]]]
        earlier = np.split(smallest < own, np.cumsum([len(i) for i in ids])[:-1])
        return _answer(key[0].as_py(), 1, part.column("g"), [bits(e) for e in earlier])

    def cut(key: tuple[pa.Scalar, ...], group: pa.Table, answers: pa.Table) -> pa.Table:
        own = Group(group, width)
        order, head, by_part = distinct(own, estimated(own, answers))
        earlier, bit = np.zeros(len(head), bool), _by_part(answers, 1)
        for number, places in by_part:
            earlier[places] = flags(bit[number], len(places))
        run = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(order)]))
        hit = order[earlier[run] | (own.id[order] > own.id[order[head]][run])] if len(order) else order
        edge = np.zeros(int(own.sizes.sum()) + 1, np.int64)
        np.add.at(edge, own.at[hit], 1)
        np.add.at(edge, own.at[hit] + width, -1)  # at most the end of the document's words
        gone = np.cumsum(edge)[:-1] > 0
        out: dict[int, tuple] = {}
        for place, words, begin in zip(own.places, own.words, own.begin.tolist()):
            mask = gone[begin : begin + len(words)]
            ends = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
            spans = [{"start": a, "end": b} for a, b in zip(ends[::2].tolist(), ends[1::2].tolist())]
            kept = [w for w, m in zip(words, mask.tolist()) if not m] if spans else words
            out[place] = len(words), len(words) - len(kept), spans, b" ".join(kept)
        rows_out = []
        for k, (i, t) in enumerate(zip(group.column("id").to_pylist(), group.column("text").to_pylist())):
            words = (t or b"").split() if i is None else None
            rows_out.append((i, *(out[k] if words is None else (len(words), 0, [], b" ".join(words)))))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows_out), CUT)], schema=CUT)

    sketch = docs.groupBy("g").applyInArrow(own_sketch, "part long, g long, cells binary, several binary")
    shared = sketch.groupBy("part").applyInArrow(merged, REPLY)
    asked = docs.groupBy("g").cogroup(shared.groupBy("g")).applyInArrow(ask, "part long, g long, keys binary, least binary")
    first = asked.groupBy("part").applyInArrow(least, REPLY)
    done = docs.groupBy("g").cogroup(shared.union(first).groupBy("g")).applyInArrow(
        cut, "id long, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept string")
    return done.select(F.col("id").cast(kind).alias(id_col), "n_words", "n_removed", "removed", "kept")


REPLY = "g long, kind int, part long, data binary"
ASKED = pa.schema([("part", pa.int64()), ("g", pa.int64()), ("cells", pa.binary()), ("several", pa.binary())])
KEYED = pa.schema([("part", pa.int64()), ("g", pa.int64()), ("keys", pa.binary()), ("least", pa.binary())])
CUT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                 ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())])


def _answer(part: int, kind: int, groups: pa.ChunkedArray, blobs: list[bytes]) -> pa.Table:
    n = len(blobs)
    return pa.table({"g": groups.combine_chunks(), "kind": pa.array([kind] * n, pa.int32()), "part": pa.array([part] * n, pa.int64()), "data": pa.array(blobs, pa.binary())})


def _by_part(answers: pa.Table, kind: int) -> dict[int, bytes]:
    rows = answers.filter(pa.compute.equal(answers.column("kind"), kind))
    return dict(zip(rows.column("part").to_pylist(), rows.column("data").to_pylist()))
