"""Phrases of two and three words that stand together more often than their parts, best first, in each language.

A phrase grows word by word from its prefix, and the count of a prefix bounds what may grow from it: with a = f(phrase), cut into
l and r, the score a * a / (l * r) is at most a / l as r >= a. So a phrase of three words that begins with p = (v, w)
scores at most f(p) / f(v). Pairs of words form the frontier. It is expanded best first, by falling bars for each language:
all pairs whose bound reaches the bar are grown to the right, and around every pair whose own score reaches it phrases are counted
that end with it, since those may swallow it. What is left unexpanded lies below the bar. Once a language has its
whole number of survivors at or above the bar, ties included, nothing below can enter and it is settled; else its bar falls, down to 0.

Counts are exact at any size. Texts are read in blocks whose distinct phrases are counted in numpy and added up by Spark. Which words and
pairs are worth a look is told to the readers by bit tables of fixed size, built in Spark: a bit set by chance costs
work, and no phrase is lost. All tables that grow with the corpus are joined by shuffles.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.common import ready
from sightline.session import scratch_path

FILTER_BITS = 26  # log2 of the bits of a table: 8 MB, whatever the input
BLOCK_BYTES = 4 << 20  # text that is counted together
EMITTED = 50_000  # rows of a batch
MILLION = 1_000_000
TOP = 2000
LEAST = 10
SWALLOWED = 50  # percent of its occurrences that a longer phrase takes up
GROWTH = 4  # how many times more of the frontier the next bar takes in

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
#: A-Z to a-z, tab to space, ends of pieces to a full stop.
LETTERS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + PIECE_ENDS, b"abcdefghijklmnopqrstuvwxyz " + b"." * len(PIECE_ENDS))
COUNTED = "lang string, phrase string, f long"


class BitTable:
    """Set of hashes by their lowest bits; may hold what was never put in, never misses what was."""

    def __init__(self, rows: list, log2: int):
        self.mask = np.uint64((1 << log2) - 1)
        self.bytes = np.zeros(1 << log2 >> 3, np.uint8)
        for row in rows:
            begin = (row["bucket"] - 1) * 4096
            self.bytes[begin : begin + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes & self.mask
        return (self.bytes[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def word_hash(word: Column) -> Column:
    return F.xxhash64(F.concat_ws("\t", "lang", word))


def pair_hash(pair: Column) -> Column:
    """Of the hashes of both words, the first one turned by 17 bits; ``Block.pair_hashes`` does the same."""
    first, second = (word_hash(F.split(pair, " ")[k]) for k in range(2))
    return F.shiftleft(first, 17).bitwiseXOR(F.shiftrightunsigned(first, 47)).bitwiseXOR(second)


def bit_table(df: DataFrame, hashed: Column, log2: int = FILTER_BITS) -> BitTable:
    """Bits of the distinct hashes of ``df``, gathered as at most 2^(log2 - 15) rows of 4 KB."""
    place = F.pmod(hashed, F.lit(1 << log2)) + 1
    rows = df.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    return BitTable(rows.collect(), log2)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


Counts = tuple[pa.Array, np.ndarray]  # phrases, and how often each was found


class Block:
    """Words of some texts of one language; number 0 parts what must not be joined."""

    def __init__(self, lang: bytes, texts: list[bytes]):
        number = _Numbers({b".": 0})
        stream = b".".join(texts).translate(LETTERS).replace(b".", b" . ").split(b" ")
        self.ids = np.fromiter(map(number.__getitem__, filter(None, stream)), np.int64)
        self.words = pa.array(list(number), pa.binary())
        head = lang + b"\t"
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(head + w, 42) for w in number), np.uint64, len(number))

    def phrases(self, *numbers: np.ndarray) -> pa.Array:
        """Words by number, joined by spaces."""
        parts = [self.words.take(pa.array(n)) for n in numbers]
        return pa.compute.binary_join_element_wise(*parts, b" ").cast(pa.string())

    def singles(self) -> Counts:
        return self.words[1:].cast(pa.string()), np.bincount(self.ids, minlength=len(self.words))[1:]

    def pair_hashes(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        h = self.hashes[first]
        return (h << np.uint64(17)) ^ (h >> np.uint64(47)) ^ self.hashes[second]

    def neighbours(self, words: BitTable) -> np.ndarray:
        """Places of words that are in ``words`` as the next one is, in the same piece."""
        known = words.holds(self.hashes)
        known[0] = False
        keep = known[self.ids]
        return np.flatnonzero(keep[:-1] & keep[1:])

    def pairs(self, words: BitTable) -> Counts:
        at = self.neighbours(words)
        codes, counts = np.unique(self.ids[at] * len(self.words) + self.ids[at + 1], return_counts=True)
        return self.phrases(*np.divmod(codes, len(self.words))), counts

    def triples(self, words: BitTable, grown: BitTable, endings: BitTable) -> Counts:
        """Triples that begin with a pair of ``grown`` or end with one of ``endings``."""
        at = self.neighbours(words)
        hashes = self.pair_hashes(self.ids[at], self.ids[at + 1])
        follow = np.flatnonzero(at[1:] == at[:-1] + 1)
        begin = at[follow[grown.holds(hashes[follow]) | endings.holds(hashes[follow + 1])]]
        base = len(self.words)
        pairs, which = np.unique(self.ids[begin] * base + self.ids[begin + 1], return_inverse=True)
        codes, counts = np.unique(which * base + self.ids[begin + 2], return_counts=True)
        pair, third = np.divmod(codes, base)
        return self.phrases(*np.divmod(pairs[pair], base), third), counts


def counted(docs: DataFrame, count: Callable[[Block], Counts]) -> DataFrame:
    """(lang, phrase, f): what ``count`` finds in blocks of text of one language, added up."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            found, counts = count(Block(lang.encode(), held.pop(lang)))
            del sizes[lang]
            name = pa.array([lang], pa.string())
            for k in range(0, len(found), EMITTED):
                part = found[k : k + EMITTED]
                langs = name.take(pa.array(np.zeros(len(part), np.int64)))
                yield pa.RecordBatch.from_arrays([langs, part, pa.array(counts[k : k + EMITTED])], ["lang", "phrase", "f"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # A long text goes in stretches cut at the end of a piece, so that a block stays small.
                for part in stretches(text):
                    held.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part)
                    if sizes[lang] >= BLOCK_BYTES or sum(sizes.values()) >= 4 * BLOCK_BYTES:
                        yield from flush(max(sizes, key=sizes.get))
        for lang in list(held):
            yield from flush(lang)

    return docs.mapInArrow(read, COUNTED).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


ENDS = re.compile(b"[%s]" % re.escape(PIECE_ENDS))


def stretches(text: bytes) -> Iterator[bytes]:
    """``text`` in parts of about BLOCK_BYTES that end where a piece ends; a longer piece stays whole."""
    begin = 0
    while len(text) - begin > BLOCK_BYTES:
        end = ENDS.search(text, begin + BLOCK_BYTES)
        if end is None:
            break
        yield text[begin : end.end()]
        begin = end.end()
    yield text[begin:]


def _scaled(product: Column, whole: Column) -> Column:
    """floor(1000000 * product / whole), exactly, beyond 64 bits too."""
    return F.call_function("div", product.cast("decimal(30,0)") * F.lit(MILLION).cast("decimal(7,0)"), whole)


def _score(a: Column, left: Column, right: Column) -> Column:
    a, left, right = (c.cast("decimal(15,0)") for c in (a, left, right))
    return _scaled(a * a, left * right)


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: counted once, and kept when an executor is lost."""
    path = scratch_path(df.sparkSession, f"phrases-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _edge(score: Column) -> Column:
    """``score`` with all but its five leading bits cleared: a few hundred classes of scores."""
    drop = F.greatest(F.length(F.bin(score)) - 5, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", score, drop), drop)


def bars(pairs: DataFrame, most: int) -> DataFrame:
    """(lang, bar): a score that ``most`` pairs of the language reach at least, 0 where it has fewer."""
    classes = pairs.groupBy("lang", _edge(F.col("score")).alias("edge")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("edge")))
    return classes.withColumn("upto", upto).groupBy("lang").agg(
        F.coalesce(F.max(F.when(F.col("upto") >= most, F.col("edge"))), F.lit(0)).cast("long").alias("bar"))


def _best_cut(cuts: list[tuple[Column, Column, Column]]) -> Column:
    """The cut of least score, the first of equal ones, as struct (score, k, l, r)."""
    found = [F.struct(s.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")) for k, (s, left, right) in enumerate(cuts)]
    return F.least(*found) if len(found) > 1 else found[0]


def scored_triples(triples: DataFrame, pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Triples (lang, phrase, f) with their score, l and r; their parts occur at least as often, so they are in the other tables."""
    part = F.split("phrase", " ")
    cut = triples.withColumns({"_w1": part[0], "_w3": part[2], "_p1": F.concat_ws(" ", part[0], part[1]), "_p2": F.concat_ws(" ", part[1], part[2])})
    for name, known in (("_w1", words), ("_w3", words), ("_p1", pairs), ("_p2", pairs)):
        cut = cut.join(known.select("lang", F.col("phrase").alias(name), F.col("f").alias(f"f{name}")), ["lang", name])
    best = _best_cut([(_score(F.col("f"), F.col(a), F.col(b)), F.col(a), F.col(b)) for a, b in (("f_w1", "f_p2"), ("f_p1", "f_w3"))])
    return cut.withColumn("_best", best).select("lang", "phrase", "f", F.col("_best.score").alias("score"), F.col("_best.l").alias("l"), F.col("_best.r").alias("r"))


def survivors(pairs: DataFrame, triples: DataFrame, words: DataFrame, swallowed: int) -> DataFrame:
    """Pairs that no counted triple swallows, and all triples."""
    part = F.split("phrase", " ")
    ends = F.array(F.concat_ws(" ", part[0], part[1]), F.concat_ws(" ", part[1], part[2]))
    inside = triples.select("lang", F.explode(ends).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    columns = ["lang", "phrase", "f", "score", "l", "r"]
    alone = pairs.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * swallowed))
    return alone.select(columns).union(scored_triples(triples, pairs, words).select(columns))


def collocations(
    df: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = TOP, least: int = LEAST, swallowed: int = SWALLOWED,
    growth: int = GROWTH, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    Texts are cut into pieces at ``. , ; : ! ?`` and line ends, pieces into words at spaces and tabs, A-Z in small letters; n counts the words of
    the language, a the occurrences of the phrase within pieces, overlaps included. A phrase needs ``least`` occurrences. Its score is
    floor(1000000 * a * a / (l * r)) for the cut where that is least, the first one of equals. A pair is left out if a triple that holds
    it, itself found ``least`` times, has ``swallowed`` percent of its occurrences or more. Order: score and a falling, then phrase by bytes.
    A null language is ``und``, null and empty texts have no words, repeated rows count again, an empty table gives no rows, and
    other columns are not read. ``growth`` and ``filter_bits`` change the cost, never the result.
    """
    spark = ready(df.sparkSession)
    docs = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text")).where("text IS NOT NULL")
    singles = _stored(counted(docs, lambda block: block.singles()), "words")
    sizes = singles.groupBy("lang").agg(F.sum("f").alias("n"))
    words = singles.where(F.col("f") >= least)
    shared = spark.sparkContext.broadcast(bit_table(words, word_hash(F.col("phrase")), filter_bits))  # 2^filter_bits bits

    part = F.split("phrase", " ")
    found = counted(docs, lambda block: block.pairs(shared.value)).where(F.col("f") >= least).withColumns({"_w1": part[0], "_w2": part[1]})
    for name, count in (("_w1", "l"), ("_w2", "r")):
        found = found.join(words.select("lang", F.col("phrase").alias(name), F.col("f").alias(count)), ["lang", name])
    bound = _scaled(F.col("f").cast("decimal(15,0)"), F.col("l").cast("decimal(15,0)"))
    pairs = _stored(found.select("lang", "phrase", "f", "l", "r", _score(F.col("f"), F.col("l"), F.col("r")).alias("score"), bound.alias("bound")), "pairs")

    #: Languages not settled yet, with the bar so far; the first one is above every bound.
    open_bars = pairs.select("lang").distinct().withColumn("before", F.lit(MILLION + 1).cast("long"))
    triples, settled, wanted = None, None, 2 * top
    while not open_bars.isEmpty():
        now = open_bars.join(bars(pairs, wanted), "lang")
        front = pairs.join(now, "lang")
        grown, endings = (front.where((F.col(c) >= F.col("bar")) & (F.col(c) < F.col("before"))) for c in ("bound", "score"))
        tables = spark.sparkContext.broadcast(tuple(bit_table(t, pair_hash(F.col("phrase")), filter_bits) for t in (grown, endings)))  # twice as many bits
        read = docs.join(open_bars.select("lang"), "lang", "left_semi") if triples is not None else docs

        def count_triples(block: Block, tables=tables) -> Counts:
            return block.triples(shared.value, *tables.value)

        more = _stored(counted(read, count_triples).where(F.col("f") >= least), "triples")
        # A triple that is counted in two rounds has its whole count in both.
        triples = more if triples is None else triples.union(more).groupBy("lang", "phrase").agg(F.max("f").alias("f"))
        alive = survivors(pairs.join(open_bars.select("lang"), "lang", "left_semi"), triples, words, swallowed)
        reached = _stored(alive.join(now, "lang").where(F.col("score") >= F.col("bar")), "reached")
        states = now.join(reached.groupBy("lang").agg(F.count("*").alias("reached")), "lang", "left")
        enough = (F.col("bar") == 0) | (F.coalesce("reached", F.lit(0)) >= top)
        states = _stored(states.withColumn("enough", enough), "states")
        final = reached.join(states.where("enough").select("lang"), "lang", "left_semi").drop("bar", "before")
        settled = final if settled is None else settled.union(final)
        open_bars = states.where("NOT enough").select("lang", F.col("bar").alias("before"))
        wanted *= growth
    if settled is None:
        settled = spark.createDataFrame([], "lang string, phrase string, f long, score long, l long, r long")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"), "phrase")
    ranked = settled.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")
