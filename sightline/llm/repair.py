"""Token ids in files, compressed by Re-Pair grammars.

Documents are written in ascending id order in blocks. In a block, frequent pairs of neighbouring ids
are replaced by new symbols (nonterminals), round after round. A row of the file holds the rules, the
expansion length of each nonterminal, the replaced sequence and where each document begins in
it; no rule reaches over the end of a document, so any document is decoded from its own stretch.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sightline.llm.common import ready

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark spreads the work

END = 1
BLOCK_TOKENS = 1 << 18
SLOT_BITS = 17
LEAST = 4  # a pair is worth a rule if it is replaced so often in the block
RULES = 4096  # pairs named in one round
CACHED_WORDS = 400_000


# ---------------------------------------------------------------- grammar


def frequent_pairs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, counts, number): the pairs that occur LEAST times in ``keys``, ascending, and for each key its pair's place, -1 if it is none."""
    found = np.sort(keys)
    starts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[starts, len(found)])
    pairs, counts = found[starts[counts >= LEAST]], counts[counts >= LEAST]
    if not len(pairs):
        return pairs, counts, np.full(len(keys), -1, np.int32)
    # A slot knows one pair; of the pairs that share one, the others are searched for.
    slot, own = _slot(keys), _slot(pairs)
    table, shared = np.zeros(1 << SLOT_BITS, np.int32), np.zeros(1 << SLOT_BITS, bool)
    table[own] = np.arange(len(pairs), dtype=np.int32)
    shared[own[pairs[table[own]] != pairs]] = True
    number = table[slot]
    other = np.flatnonzero(pairs[number] != keys)
    number[other] = -1
    other = other[shared[slot[other]]]
    place = np.searchsorted(pairs, keys[other]).clip(max=len(pairs) - 1)
    number[other] = np.where(pairs[place] == keys[other], place, -1)
    return pairs, counts, number


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def compress(ids: np.ndarray, end: int = END) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, rules, first nonterminal): rule k of the pairs in ``rules`` stands for symbol first + k.

    Each round names the most frequent pairs and replaces their occurrences, a pair that overlaps a more frequent
    one giving way, until no pair occurs LEAST times. Pairs with ``end`` are never named.

    What a round makes new are pairs with a symbol of that round, so a pair below LEAST never comes back: a round counts the
    pairs that were frequent and those next to a new symbol, not the whole sequence.
    """
    first = int(ids.max()) + 1 if len(ids) else 0
    seq, rules, symbols = ids.astype(np.uint32), [], first
    live = np.ones(len(seq), bool)  # a pair that begins here may be frequent
    while len(seq) > 1:
        live[-1] = False
        at = np.flatnonzero(live)
        at = at[(seq[at] != end) & (seq[at + 1] != end)]
        pairs, counts, number = frequent_pairs(seq[at].astype(np.uint64) << np.uint64(32) | seq[at + 1])
        if not len(pairs):
            break
        at, number = at[number >= 0], number[number >= 0]
        live[:] = False
        live[at] = True
        best = np.argsort(-counts, kind="stable")[:RULES]
        rank = np.zeros(len(pairs), np.int64)
        rank[best] = np.arange(len(best), 0, -1)
        weighed = rank[number] > 0
        at, number = at[weighed], number[weighed]
        weight = rank[number]
        # The heavier of two overlapping pairs goes first; in a run of one pair every other occurrence.
        touch = np.r_[False, np.diff(at) == 1, False]
        left, right = np.where(touch[:-1], np.r_[0, weight[:-1]], 0), np.where(touch[1:], np.r_[weight[1:], 0], 0)
        run = weight == left
        run_start = np.maximum.accumulate(np.where(run, 0, at))
        taken = (weight >= right) & (weight >= left) & ((at - run_start) % 2 == 0)
        taken &= ~(np.r_[False, taken[:-1]] & touch[:-1])
        # A rule needs two uses; the most frequent pair always has them, so every round shortens the sequence.
        uses = np.bincount(number[taken], minlength=len(pairs))
        taken &= uses[number] > 1
        named = uses > 1
        if not named.any():
            break
        place = np.cumsum(named) - 1
        gone = at[taken]
        seq[gone] = symbols + place[number[taken]]
        live[gone] = live[gone[gone > 0] - 1] = True
        keep = np.ones(len(seq), bool)
        keep[gone + 1] = False
        seq, live = seq[keep], live[keep]
        rules.append(pairs[named])
        symbols += int(named.sum())
    flat = np.concatenate([np.zeros(0, np.uint64), *rules])
    return seq, np.stack([flat >> np.uint64(32), flat & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32), first


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """How many ids each nonterminal stands for; a rule only uses symbols before its own."""
    lengths = np.ones(len(rules), np.int64)
    waiting = np.ones(len(rules), bool)
    inner = rules.astype(np.int64) - first
    while waiting.any():
        known = np.all((inner < 0) | ~waiting[np.maximum(inner, 0)], axis=1) & waiting
        parts = np.where(inner[known] < 0, 1, lengths[np.maximum(inner[known], 0)])
        lengths[known] = parts.sum(1)
        waiting[known] = False
    return lengths


def expand(seq: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """The ids that a stretch of a sequence stands for."""
    seq = seq.astype(np.int64)
    while True:
        open_ = seq >= first
        if not len(rules) or not open_.any():
            return seq.astype(np.uint32)
        place = np.arange(len(seq)) + np.cumsum(open_) - open_
        out = np.empty(len(seq) + int(open_.sum()), np.int64)
        pair = rules[seq[open_] - first]
        out[place[~open_]] = seq[~open_]
        out[place[open_]] = pair[:, 0]
        out[place[open_] + 1] = pair[:, 1]
        seq = out


def decoder(rules: np.ndarray, first: int, lengths: np.ndarray):
    """A function that expands any stretch of a sequence, from the expansions of all nonterminals laid end to end."""
    flat = expand(np.arange(first, first + len(rules)), rules, first)
    begin = np.cumsum(lengths) - lengths

    def decode(seq: np.ndarray) -> np.ndarray:
        symbol = seq.astype(np.int64) - first
        named = symbol >= 0
        size = np.ones(len(seq), np.int64)
        base = np.arange(len(seq)) + len(flat)
        size[named], base[named] = lengths[symbol[named]], begin[symbol[named]]
        ends = np.cumsum(size)
        return np.concatenate([flat, seq])[np.repeat(base - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]

    return decode


# ---------------------------------------------------------------- ids


def _kind(code: int) -> str:
    char = chr(code)
    return "." if char in ".," else " " if char.isspace() else "a" if unicodedata.category(char)[0] in "LN" else "!"


_KINDS = "".join(map(_kind, range(256))).encode()  # of the Latin-1 characters: full stop or comma, space, letter or number, other
# Python's split() also takes four control characters for white space, the library does not.
_ODD = re.compile("[\x1c-\x1f]").search
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


class WordCodec:
    """Ids of texts by the tokenizers library, word by word: this kind of vocabulary drops white space and never joins over it."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.known: dict[str, bytes] = {}
        self.ends = np.zeros(self.library.get_vocab_size(), bool)  # ids that end a piece
        for token, number in self.library.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        self._learn([".", ","])
        self.marks = {"": b"", ".": self.known["."], ",": self.known[","]}

    def _learn_letters(self, words: list[str]) -> None:
        """Words of letters alone, many in one text: each gives one piece, so its ids run to the next id that ends a piece."""
        for at in range(0, len(words), 5000):
            part = words[at : at + 5000]
            ids = np.array(self.library.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.int64)
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cuts) != len(part):
                self._learn(part)
                continue
            raw = ids.astype("<u4").tobytes()
            self.known.update(zip(part, [raw[a:b] for a, b in zip([0, *cuts], cuts)]))

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 5000):
            part = words[at : at + 5000]
            found = self.library.encode(part, is_pretokenized=True, add_special_tokens=False)
            owner = np.array(found.word_ids, np.int64)
            ids = np.array(found.ids, "<u4").tobytes()
            cuts = (4 * np.searchsorted(owner, np.arange(len(part) + 1))).tolist()
            self.known.update(zip(part, [ids[a:b] for a, b in zip(cuts, cuts[1:])]))

    def _split(self, text: str) -> list[str]:
        """Words whose ids, one after the other, are those of the text.

        Case is dropped and full stops and commas are set apart where that surely changes nothing, since fewer
        different words have to be remembered then.
        """
        if _ODD(text):
            return _SPACE.split(text)
        try:
            kinds = text.encode("latin-1").translate(_KINDS)
        except UnicodeEncodeError:
            return text.split()
        text = text.lower()
        # Next to another mark, a full stop or comma is part of a longer piece.
        if b".." in kinds or b"!." in kinds or b".!" in kinds:
            return text.split()
        return text.replace(".", " . ").replace(",", " , ").split()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [self._split(t) if t else [] for t in texts]
        if len(self.known) > CACHED_WORDS:  # the words learned first are mostly the frequent ones
            self.known = dict(islice(self.known.items(), CACHED_WORDS // 2))
        known = self.known
        found = [list(map(known.get, words)) for words in split]
        new = {w for words, ids in zip(split, found) if None in ids for w, x in zip(words, ids) if x is None}
        bases, parts, rest = set(), [], []
        for word in new:
            base, mark = (word[:-1], word[-1]) if len(word) > 1 and word[-1] in ".," else (word, "")
            if base.isalpha() and max(base) <= "\xff":  # one piece, and a full stop or comma is a piece of its own
                base = base.lower() if base.isascii() else base
                parts.append((word, base, mark))
                if base not in known:
                    bases.add(base)
            else:
                rest.append(word)
        self._learn_letters(list(bases))
        for word, base, mark in parts:
            known[word] = known[base] + self.marks[mark]
        self._learn(rest)
        return [b"".join([known[w] if x is None else x for w, x in zip(words, ids)] if None in ids else ids) for words, ids in zip(split, found)]


@lru_cache(2)
def word_codec(path: str) -> WordCodec:
    return WordCodec(path)


FILE = "shard int, block int, before long, doc_ids binary, null_ids binary, n_tokens binary, offsets binary, sequence binary, rules binary, lengths binary, first long"


def write_token_files(df: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end: int = END, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode every text, append ``end``, and write the ids in ascending ``id_col`` order as compressed blocks below ``folder``.

    A null text counts as empty, so it is ``end`` alone; null ids come first, rows with equal ids are ordered by
    text. Ids are integers. Rows are dealt to ranges of ids, each range is one shard and is encoded as a stream, with
    one block in memory.
    """
    ready(df.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_codec(tokenizer_path)
        closing = np.array([end], "<u4").tobytes()
        docs: list = []
        ids: list[bytes] = []
        size, block, shard, before = 0, 0, 0, 0

        def flush() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(ids), "<u4")
            seq, rules, first = compress(flat, end)
            lengths = np.array([len(x) // 4 for x in ids], np.int64)
            # Ends never enter a rule, but they may occur inside a text too: count what precedes each border.
            grown = expansion_lengths(rules, first)
            step = np.where(seq >= first, grown[np.maximum(seq.astype(np.int64) - first, 0)] if len(rules) else 1, 1)
            offsets = np.searchsorted(np.cumsum(step) - step, np.cumsum(lengths) - lengths)
            packed = [
                [shard], [block], [before], [np.array([d or 0 for d in docs], np.int64).tobytes()], [np.array([d is None for d in docs]).tobytes()],
                [lengths.tobytes()], [offsets.astype(np.int64).tobytes()], [_pack(seq)], [_pack(rules.ravel())], [grown.astype(np.uint32).tobytes()], [first],
            ]
            kinds = [pa.int32()] * 2 + [pa.int64()] + [pa.binary()] * 7 + [pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(p, k) for p, k in zip(packed, kinds)], [f.split()[0] for f in FILE.split(", ")])

        for batch in batches:
            texts, names = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            if len(texts):
                shard = batch.column(2)[0].as_py()
            for name, raw in zip(names, codec.encode(texts)):
                docs.append(name), ids.append(raw + closing)
                size += len(raw) // 4 + 1
                if size >= block_tokens:
                    yield flush()
                    docs, ids, size, block, before = [], [], 0, block + 1, before + size
        if docs:
            yield flush()

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ranged = rows.repartitionByRange("id").sortWithinPartitions("id", "text").withColumn("shard", F.spark_partition_id())
    ranged.mapInArrow(write, FILE).write.parquet(folder)


def _pack(symbols: np.ndarray) -> bytes:
    """Symbols as 16-bit numbers where they fit, else 32-bit; the first byte tells which."""
    narrow = not len(symbols) or int(symbols.max()) < 1 << 16
    return (b"\x02" if narrow else b"\x04") + symbols.astype("<u2" if narrow else "<u4").tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw[0] == 2 else "<u4", offset=1).astype(np.uint32)


def read_token_files(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """(``id_col``, start, n_tokens, tokens) of every document in the files; tokens are little-endian 32-bit ids.

    start counts the ids of all documents before it: a block knows those of its shard, and shards are summed up in order.
    """
    blocks = spark.read.schema(FILE).parquet(folder)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                seq, rules = _unpack(row["sequence"]), _unpack(row["rules"]).reshape(-1, 2)
                names, null = np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["null_ids"], bool)
                sizes, offsets = np.frombuffer(row["n_tokens"], np.int64), np.frombuffer(row["offsets"], np.int64)
                decode_stretch = decoder(rules, row["first"], np.frombuffer(row["lengths"], np.uint32).astype(np.int64))
                borders = np.r_[offsets, len(seq)]
                begin = np.cumsum(sizes) - sizes
                for at in range(0, len(names), 1000):
                    to = min(at + 1000, len(names))
                    raw = decode_stretch(seq[borders[at] : borders[to]]).astype("<u4").tobytes()
                    ends = (4 * np.cumsum(sizes[at:to])).tolist()
                    parts = [raw[a:b] for a, b in zip([0, *ends], ends)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(to - at, row["shard"], np.int32)), pa.array(names[at:to], mask=null[at:to]), pa.array(row["before"] + begin[at:to]), pa.array(sizes[at:to]), pa.array(parts, pa.binary())],
                        ["shard", "id", "inside", "n_tokens", "tokens"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(np.frombuffer(x, np.int64).sum()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.int64())], ["shard", "n"])

    # One number for each shard, so as many as the writing tasks: safe to sum up in order and to broadcast.
    whole = blocks.select("shard", "n_tokens").mapInArrow(total, "shard int, n long").groupBy("shard").agg(F.sum("n").alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(whole.select("shard", ahead.alias("start")))
    docs = blocks.mapInArrow(decode, "shard int, id long, inside long, n_tokens long, tokens binary")
    return docs.join(starts, "shard").select(F.col("id").alias(id_col), (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "tokens")
