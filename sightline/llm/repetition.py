"""Quality rules on repetition: the share of a text's characters inside repeated word windows and repeated lines."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from sightline.llm.common import ready
from sightline.llm.rolling import Texts, chunks, repeated, seen_before

SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
LENGTHS = (5, 7, 10)
LIMITS = {5: 0.40, 7: 0.38, 10: 0.35}  # share of word characters in windows of so many words found twice or more
LINE_LIMIT = 0.30  # share of word characters in lines equal to an earlier line
MIN_WORDS, MAX_REPEAT = 50, 50  # words at least; words in repeated 3-word windows of 100 at most

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *(f"dup_{n}gram_chars" for n in LENGTHS))
RESULT = StructType([StructField(c, LongType()) for c in COUNTS])


def repetition_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    own = Texts(texts)
    points = np.concatenate([[0], np.cumsum((own.data & 0xC0) != 0x80)])  # code points before each byte
    chars = points[own.end] - points[own.start]
    raw = own.data.tobytes()

    def digests(start: np.ndarray, end: np.ndarray, seeds) -> np.ndarray:
        """Hashes of whole words and lines. A polynomial modulo 2^64 would take some long strings of two letters for equal."""
        return np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b], s) for a, b, s in zip(start.tolist(), end.tolist(), seeds)), np.uint64, len(start))

    value = digests(own.start, own.end, repeat(0))

    def covered(n: int) -> np.ndarray:
        at, keys = own.grams(value, n)
        inside = np.zeros(len(own.start) + 1, np.int64)
        hit = at[repeated(keys)]
        np.add.at(inside, hit, 1)
        np.add.at(inside, hit + n, -1)
        return np.cumsum(inside[:-1]) > 0

    breaks = np.flatnonzero(own.data == 10)
    line_start = np.r_[0, breaks[:-1] + 1]
    line_doc = np.searchsorted(own.begin, line_start, "right") - 1
    first = np.searchsorted(own.start, line_start)
    last = np.searchsorted(own.start, breaks)
    real = last > first
    line_start, line_end, line_doc, first, last = line_start[real], breaks[real], line_doc[real], first[real], last[real]
    again = seen_before(digests(line_start, line_end, line_doc.tolist()))
    before = np.concatenate([[0], np.cumsum(chars)])
    out = {
        "n_words": own.words,
        "word_chars": own.per_text(chars, own.doc),
        "n_symbols": own.per_text(*(lambda at: (np.ones(len(at)), np.searchsorted(own.begin, at, "right") - 1))(np.flatnonzero(SYMBOLS[own.data]))),
        "n_dup_lines": own.per_text(again, line_doc),
        "n_repeat_words": own.per_text(covered(3), own.doc),
        "dup_line_chars": own.per_text((before[last] - before[first]) * again, line_doc),
    }
    for n in LENGTHS:
        out[f"dup_{n}gram_chars"] = own.per_text(chars * covered(n), own.doc)
    return out


@F.pandas_udf(RESULT)
def _counts(texts: pd.Series) -> pd.DataFrame:
    parts = [pd.DataFrame(repetition_counts(chunk)) for chunk in chunks(texts)]
    return pd.concat(parts)[list(COUNTS)] if parts else pd.DataFrame(columns=list(COUNTS), dtype="int64")


def repetition_rules(df: DataFrame, text_col: str = "text", output: str = "repetition") -> DataFrame:
    """``df`` with a struct ``output`` of counts, shares, base_failed and kept for every whole text.

    Words are runs of characters other than space, tab, line feed, vertical tab, form feed and carriage return. A
    null, empty or blank text has no words, so it fails the base rule and is not kept. A column named like ``output``
    is replaced, all others are kept.
    """
    ready(df.sparkSession)
    raw = df.withColumn(output, _counts(F.col(text_col)))
    field = lambda name: F.col(f"{output}.{name}")
    share = lambda name: field(name) / F.greatest(field("word_chars"), F.lit(1)).cast(DoubleType())
    failed = (field("n_words") < MIN_WORDS) | (100 * field("n_repeat_words") > MAX_REPEAT * field("n_words"))
    fine = share("dup_line_chars") <= LINE_LIMIT
    for n, limit in LIMITS.items():
        fine = fine & (share(f"dup_{n}gram_chars") <= limit)
    return raw.withColumn(output, F.struct(*(field(c).alias(c) for c in COUNTS), failed.alias("base_failed"), (~failed & fine).alias("kept")))
