"""Fill-in-the-middle examples cut with a learned rank index.

A text is a run of tokens (white space and the word behind it; white space at the end is one of its own). A cut
asks for the place of a token's end by its number. That is a lookup by rank, and the index for it is learned: the
boundaries of a text form a rising curve over their ranks, straight segments follow it within an error bound, and what
each prediction misses by is kept in one byte. Predicted place plus residual is the exact place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sightline.llm.common import ready

ERROR = 100  # characters a segment may be off; a residual then fits one byte
MARKS = PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class RankIndex:
    """Places by rank: ``index[k]`` is the k-th of the rising ``places``, exactly, in two lookups.

    A segment starts on a place and goes on as long as one slope passes all its places within ``error`` (the cone of
    slopes that do so only ever narrows). Residuals are at most ``error`` + 1, so they take a byte up to 126.
    """

    def __init__(self, places: np.ndarray, error: int = ERROR):
        self.error = error
        firsts, slopes, at, look = [], [], 0, 64
        while at < len(places):
            step = np.arange(1, min(look, len(places) - at))
            rise = places[at + 1 : at + 1 + len(step)] - places[at]
            low = np.maximum.accumulate((rise - error) / step)
            high = np.minimum.accumulate((rise + error) / step)
            out = np.flatnonzero(low > high)
            if not len(out) and at + look < len(places):
                look *= 2  # the segment may go on: look further
                continue
            reach = int(out[0]) if len(out) else len(step)
            firsts.append(at)
            slopes.append((low[reach - 1] + high[reach - 1]) / 2 if reach else 0.0)
            at += reach + 1
            look = max(64, min(look, 2 * reach + 2))
        self.first = np.array(firsts, np.int64)
        self.slope = np.array(slopes, np.float64)
        self.base = places[self.first] if len(self.first) else np.zeros(0, np.int64)
        self.residual = np.zeros(0, np.int8)
        off = places - self.predicted(np.arange(len(places)))
        self.residual = off.astype(np.int8 if error <= 126 else np.int64)

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        segment = np.searchsorted(self.first, ranks, "right") - 1
        return self.base[segment] + np.floor(self.slope[segment] * (ranks - self.first[segment])).astype(np.int64)

    def __len__(self) -> int:
        return len(self.residual)

    def __getitem__(self, rank: int) -> int:
        return int(self.predicted(np.array([rank]))[0]) + int(self.residual[rank])


def boundaries(text: str) -> np.ndarray:
    """0 and the end of each token of ``text``, in code points."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    blank = (code == 32) | ((code >= 9) & (code <= 13))
    ends = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
    tail = [len(code)] if len(code) and blank[-1] else []
    return np.concatenate([[0], ends, tail]).astype(np.int64)


def rearranged(text: str, draws: tuple[int, int, int, int], rate: int, suffix_first: int, error: int) -> dict:
    """One example: ``draws`` choose the two cuts, whether the text is cut and in which order."""
    index = RankIndex(boundaries(text), error)
    n = len(index) - 1
    plain = {"n": n, "form": "plain", "prefix_chars": None, "middle_chars": None, "output": text}
    if not text or draws[2] % 100 >= rate or any(m in text for m in MARKS):
        return plain
    a, b = (index[k] for k in sorted((draws[0] % (n + 1), draws[1] % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < suffix_first:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return {"n": n, "form": form, "prefix_chars": a, "middle_chars": b - a, "output": output}


def restore(output: str, form: str) -> str:
    """The text an example was made from. A mark cannot begin inside a part and end in the next mark, so the first one counts."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    one, _, rest = output[len(first) :].partition(second)
    two, _, middle = rest.partition(MIDDLE)
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return prefix + middle + suffix


FIELDS = [StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()),
          StructField("middle_chars", LongType()), StructField("output", StringType()), StructField("restored", StringType())]


def drawn(id_col: str, seed: int) -> Column:
    """Hex digest that the draws of a row come from; a null id counts as empty."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)


def fill_in_middle(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", output: str = "infill", seed: int = 42, rate: int = 50,
    suffix_first: int = 80, error: int = ERROR,
) -> DataFrame:
    """``df`` with a struct ``output``: n (tokens), form (plain, spm, psm), prefix_chars, middle_chars, output and restored.

    ``rate`` percent of the texts are cut at two token borders, ``suffix_first`` percent of those are written suffix first. Draws depend on
    ``seed`` and the id alone, so rows of one id are cut by the same draws and a rerun cuts alike. Texts that are null or empty, or that
    hold a mark, stay plain (null as the empty text); plain texts have null lengths. ``restored`` is the text rebuilt from output and form.
    A column of ``df`` named like ``output`` is replaced, all others are kept and not read.
    """
    ready(df.sparkSession)

    @F.arrow_udf(StructType(FIELDS))
    def infill(texts: pa.Array, digests: pa.Array) -> pa.Array:
        rows = []
        for text, digest in zip(texts.to_pylist(), digests.to_pylist()):
            draws = tuple(int(digest[k : k + 8], 16) for k in range(0, 32, 8))
            row = rearranged(text or "", draws, rate, suffix_first, error)
            rows.append([*row.values(), restore(row["output"], row["form"])])
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)]
        return pa.StructArray.from_arrays(columns, [f.name for f in FIELDS])

    return df.withColumn(output, infill.asNondeterministic()(F.col(text_col), drawn(id_col, seed)))
