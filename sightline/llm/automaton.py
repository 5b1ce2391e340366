"""Benchmark decontamination with a generalised suffix automaton over the normalised items.

The automaton holds every word sequence of every item. Training words are streamed through it; the
length of the longest match ending at a word tells whether a window of an item ends there: ten
consecutive words of the item, or the whole item if it is shorter. The words of such windows are hit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from sightline.llm.common import ready, unused_name

# Bytes that belong to no word: all of ASCII but digits and letters. Text is lower-cased before.
_BLANK = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
ITEM_BYTES = 16 << 20  # items are indexed in blocks of so many bytes at most


def words_of(text: str | bytes | None) -> list[bytes]:
    """Lower-cased (A-Z only) runs of digits, ASCII letters and all characters beyond ASCII."""
    if not text:
        return []
    raw = text.encode() if isinstance(text, str) else text
    return raw.lower().translate(_BLANK).split()


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the items that own each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = 10):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = []
        for item, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            if ids:
                sequences.append((item, ids))
        self.least = min((min(window, len(ids)) for _, ids in sequences), default=0)
        for _, ids in sequences:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        owners = [set() for _ in self.next]
        whole: list[list[tuple[int, str]]] = [[] for _ in self.next]
        for item, ids in sequences:
            state = 0
            for c in ids:
                state = self.next[state][c]
                owners[state].add(item)
            if len(ids) < window:
                whole[state].append((len(ids), item))
        # States by descending length: what ends at a state also ends at its suffix link.
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                owners[self.link[state]] |= owners[state]
        self.found: list[tuple[int, frozenset[str]]] = [(0, frozenset())] * len(self.next)
        self.short: list[tuple[int, frozenset[str]]] = [(0, frozenset())] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            longest, names = self.short[up]
            if whole[state]:  # the whole of a short item ends here
                longest = max(longest, *(n for n, _ in whole[state]))
                names = names | {i for _, i in whole[state]}
            self.short[state] = (longest, names)
            if self.length[up] >= window:  # the last ``window`` words of a longer match belong to a shorter state
                self.found[state] = self.found[up]
            elif self.length[state] >= window:
                self.found[state] = (window, frozenset(owners[state]))
        n = max(1, len(self.vocabulary))
        codes = {a * n + b for _, ids in sequences for a, b in zip(ids, ids[1:])}
        self.pair_codes = np.array([*sorted(codes), n * n], np.int64)

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, c, q)
        self.next.append({}), self.link.append(0), self.length.append(self.length[last] + 1)
        state, p = len(self.next) - 1, last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return state

    def _clone(self, p: int, c: int, q: int) -> int:
        self.next.append(dict(self.next[q])), self.link.append(self.link[q]), self.length.append(self.length[p] + 1)
        clone = len(self.next) - 1
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def matches(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Spans (start, end) of hit words, not merged, and the items whose windows occur.

        Only stretches whose neighbouring words all stand side by side in some item are streamed: outside them
        the automaton falls back to a match of one word at most, so nothing is lost.
        """
        items: set[str] = set()
        if not self.least or not words:
            return np.zeros((0, 2), np.int64), items
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        known = ids >= 0
        joined = known[1:] & known[:-1]
        at = np.flatnonzero(joined)
        if len(at):
            code = ids[at] * len(self.vocabulary) + ids[at + 1]
            where = np.searchsorted(self.pair_codes, code)  # the last code is larger than any pair
            joined[at] = self.pair_codes[where] == code
        heads = np.flatnonzero(known & np.r_[True, ~joined])
        ends = np.flatnonzero(known & np.r_[~joined, True]) + 1
        long = ends - heads >= self.least
        spans = []
        for a, b in zip(heads[long].tolist(), ends[long].tolist()):
            state, length = 0, 0
            for j, c in enumerate(ids[a:b].tolist(), a):
                while state and c not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
                state = self.next[state].get(c, 0)
                length = length + 1 if state else 0
                for end, table in self._ending(state, length):
                    n, names = table[end]
                    if n:
                        spans.append((j + 1 - n, j + 1))
                        items |= names
        return np.array(spans, np.int64).reshape(-1, 2), items

    def _ending(self, state: int, length: int):
        """The tables that hold for a match of ``length`` at ``state``: the match may be shorter than the state's longest."""
        if length >= self.window:
            yield state, self.found
        # A whole short item is the longest string of its state, so it counts only if the match is that long.
        yield (state if length == self.length[state] else self.link[state]), self.short


RESULT = StructType(
    [
        StructField("n_words", LongType()),
        StructField("spans", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))),
        StructField("items", ArrayType(StringType())),
    ]
)


def _merged(spans: np.ndarray) -> list[dict]:
    if not len(spans):
        return []
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    heads = np.flatnonzero(np.r_[True, spans[1:, 0] > reach[:-1]])
    ends = reach[np.r_[heads[1:] - 1, len(spans) - 1]]
    return [{"start": int(a), "end": int(b)} for a, b in zip(spans[heads, 0], ends)]


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in blocks of about ``block_bytes`` of text, read one partition after the other."""
    block, size = [], 0
    for row in benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t")).where("i is not null").toLocalIterator():
        words = words_of(row["t"])
        if not words:
            continue
        if block and size + len(row["t"]) > block_bytes:
            yield block
            block, size = [], 0
        block.append((row["i"], words))
        size += len(row["t"])
    yield block


def benchmark_hits(
    df: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_bytes: int = ITEM_BYTES,
    output: str = "hits",
    rest: bool = False,
) -> DataFrame:
    """``df`` with a struct ``output``: n_words, spans (merged runs of hit words) and items (ids as text, sorted).

    A null or wordless text has no words, spans or items. Items that are null or wordless own no window, an empty
    benchmark hits nothing. A column of ``df`` named like ``output`` is replaced, all others are kept. Items are
    indexed in blocks of bounded size; each block is sent to the executors and all texts are streamed through
    it, so a benchmark of any size works, at one pass over the texts for each block. With ``rest`` the struct also has
    rest, the text without its hit spans.
    """
    spark = ready(df.sparkSession)
    held = unused_name(df, "_hits_so_far")
    kind = StructType([*RESULT.fields, StructField("rest", StringType())]) if rest else RESULT
    out = df
    blocks = 0
    for block in item_blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = spark.sparkContext.broadcast(SuffixAutomaton(block, window))

        @F.pandas_udf(kind)
        def scan(texts: pd.Series) -> pd.DataFrame:
            automaton = shared.value
            rows = []
            for text in texts:
                words = words_of(text)
                spans, items = automaton.matches(words)
                rows.append((len(words), _merged(spans), sorted(items)))
            return _frame(rows, texts, rest)

        @F.pandas_udf(kind)
        def merge(texts: pd.Series, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            rows = []
            for n, a, b, i, k in zip(left["n_words"], left["spans"], right["spans"], left["items"], right["items"]):
                spans = [(s["start"], s["end"]) for s in (*a, *b)]
                rows.append((n, _merged(np.array(spans, np.int64).reshape(-1, 2)), sorted({*i, *k})))
            return _frame(rows, texts, rest)

        # Not to be run again where a filter on the hits is pushed down.
        hits = scan.asNondeterministic()(F.col(text_col))
        out = out.withColumn(held, hits if not blocks else merge.asNondeterministic()(F.col(text_col), F.col(held), hits))
        blocks += 1
    return out.drop(output).withColumnRenamed(held, output)


def hit_words(column: str = "hits") -> F.Column:
    return F.aggregate(F.col(f"{column}.spans"), F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _without(text: str | None, spans: list[dict]) -> str | None:
    """The text without the words of its spans and what lies between them."""
    if text is None or not spans:
        return text
    places = [m.span() for m in re.finditer(_WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))]
    kept, at = [], 0
    for s in spans:
        kept.append(text[at : places[s["start"]][0]])
        at = places[s["end"] - 1][1]
    return "".join([*kept, text[at:]])


def _frame(rows: list[tuple], texts: pd.Series, rest: bool) -> pd.DataFrame:
    found = pd.DataFrame(rows, columns=["n_words", "spans", "items"])
    if rest:
        found["rest"] = pd.Series([_without(t, spans) for t, (_, spans, _) in zip(texts, rows)], dtype=object)
    return found


def remove_hits(df: DataFrame, hits: str = "hits", text_col: str = "text", max_coverage: float = 0.5) -> DataFrame:
    """Put the texts without their hit spans in place; documents with more than ``max_coverage`` of their words hit go.

    ``hits`` comes from ``benchmark_hits`` with ``rest``.
    """
    share = hit_words(hits) / F.greatest(F.col(f"{hits}.n_words"), F.lit(1))
    return df.where(share <= max_coverage).withColumn(text_col, F.col(f"{hits}.rest"))
