"""Language identification, word first.

A word of the model counts with its log frequency in each language. An unseen word falls back to its
character grams, the longest length first, until some gram of that length is known.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from sightline.llm.common import ready

TRAIN_DOCUMENTS = 4_000  # documents a model is fitted on, at most
LANGUAGE_WORDS = 30_000  # words of the fitted documents that a model knows for each language, at most, the most frequent
LONGEST = 5
UNKNOWN = "und"
_RUNS = re.compile(r"[^\W\d_]+").findall
CACHED_WORDS = 300_000


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of word characters without digits; those without a letter are sorted out by ``has_letter``."""
    return _RUNS(text.lower()) if text else []


def has_letter(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[k : k + n] for k in range(len(marked) - n + 1)]


class Model:
    """Log frequencies of words and grams in each language, as rows of one matrix."""

    def __init__(self, counts: list[tuple[str, str, int]]):
        self.languages = sorted({lang for lang, _, _ in counts})
        place = {lang: k for k, lang in enumerate(self.languages)}
        words: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(place)))
        for lang, word, n in counts:
            words[word][place[lang]] += n
        self.row: dict[str, int] = {}
        tables = [self._add(words, "")]
        for n in range(LONGEST, 0, -1):
            table: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(place)))
            for word, row in words.items():
                for gram in grams(word, n):
                    table[gram] += row
            tables.append(self._add(table, str(n)))
        self.weights = np.concatenate(tables)
        self.cache: dict[str, tuple[int, ...]] = {}

    def _add(self, table: dict[str, np.ndarray], kind: str) -> np.ndarray:
        """Rows of a table; words and grams of each length are told apart by a prefix that no word holds."""
        base = len(self.row)
        for k, name in enumerate(table):
            self.row[kind + name] = base + k
        seen = np.array(list(table.values())).reshape(len(table), len(self.languages))
        return np.log((seen + 0.5) / (seen.sum(0) + 0.5 * max(1, len(table))))

    def rows_of(self, word: str) -> tuple[int, ...]:
        """Rows whose mean is the word's score; none for a word without a letter or any known gram."""
        if not has_letter(word):
            return ()
        if word in self.row:
            return (self.row[word],)
        for n in range(LONGEST, 0, -1):
            known = tuple(self.row[g] for g in (str(n) + x for x in grams(word, n)) if g in self.row)
            if known:
                return known
        return ()

    def predict(self, text: str | None) -> tuple[str, float]:
        rows, weights, letters = [], [], False
        cache = self.cache
        for word in words_of(text):
            found = cache.get(word)
            if found is None:
                found = self.rows_of(word)
                if len(cache) >= CACHED_WORDS:
                    cache.clear()
                cache[word] = found
            if len(found) == 1:
                rows.append(found[0])
                weights.append(1.0)
            elif found:
                rows.extend(found)
                weights.extend([1 / len(found)] * len(found))
            letters = letters or bool(found) or has_letter(word)
        if not letters or not self.languages:
            return UNKNOWN, 0.0
        total = np.array(weights) @ self.weights[rows] if rows else np.zeros(len(self.languages))
        odds = np.exp(total - total.max())
        best = int(np.argmax(odds))  # ties go to the first language in order
        return self.languages[best], float(odds[best] / odds.sum())


def train(documents: DataFrame, lang_col: str = "lang", text_col: str = "text", most_words: int = LANGUAGE_WORDS) -> Model:
    """A model from the given documents, whose number the caller bounds; null texts or languages are left out.

    Words are counted in the tasks and summed by Spark; the ``most_words`` most frequent of each language come to the driver,
    ties in the order of words, so a rare language keeps its words beside a common one. A kept word comes with its counts in all languages.
    """
    ready(documents.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[tuple[str, str], int] = defaultdict(int)
            for lang, text in zip(batch["lang"], batch["text"]):
                for word in words_of(text):
                    seen[lang, word] += 1
            rows = [(lang, word, n) for (lang, word), n in seen.items() if has_letter(word)]
            yield pd.DataFrame(rows, columns=["lang", "word", "n"])

    known = documents.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = known.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    frequent = counts.withColumn("place", place).where(F.col("place") <= most_words).select("word").distinct()
    kept = counts.join(frequent, "word", "left_semi").orderBy("word", "lang").collect()
    return Model([(r["lang"], r["word"], r["n"]) for r in kept])


RESULT = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


def predict_languages(df: DataFrame, model: Model, text_col: str = "text", output: str = "language") -> DataFrame:
    """``df`` with a struct ``output`` (lang_pred, score) for every whole text.

    Texts that are null or have no letter, and all texts under a model without languages, are ``und`` with score 0. The
    model is bounded by the number of its words. A column named like ``output`` is replaced, all others are kept.
    """
    shared = ready(df.sparkSession).sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return df.withColumn(output, predict(F.col(text_col)))
