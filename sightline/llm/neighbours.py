"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine on a block-max inverted index.

Terms are the words and word beginnings that occur in examples of label 1 more often than chance allows. Examples
lie in blocks; for each term a block knows its largest weight. A text adds these up to a bound for each
block and opens blocks from the highest bound on, until no other can hold one of the nearest ones.
The neighbours vote with a power of their cosine, and votes become probabilities by monotone calibration on the
examples themselves, each judged by the others.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from sightline.llm.common import cut_lineage, ready

TRAIN_DOCUMENTS = 12_000  # labelled documents that are examples, at most
MOST_TERMS = 5_000
SURPRISE = 5.0  # standard deviations by which a term exceeds its expected count in label 1
BEGINNING = 4  # letters of a word beginning
BLOCK = 256
CALIBRATED = 2_000  # examples that votes are calibrated on, at most
REMEMBERED = 100_000  # judgements a worker keeps: many texts hold the same few terms
NEIGHBOURS = 31
SHARPNESS = 4  # power of the cosine in a vote
LEAST_HELD = 4  # examples that hold a term, at least
_RUNS = re.compile(r"[^\W\d_]+").findall


def terms_of(text: str | None, known: frozenset[str] | None = None) -> Counter:
    """How often each lower-cased word, and each beginning of longer ones, occurs; only the ``known`` if given."""
    counts: Counter = Counter()
    for word, n in Counter(_RUNS(text.lower())).items() if text else ():
        if known is None or word in known:
            counts[word] += n
        if len(word) > BEGINNING:
            begin = word[:BEGINNING] + "*"
            if known is None or begin in known:
                counts[begin] += n
    return counts


class BlockMaxIndex:
    """Unit TF-IDF vectors of examples, in blocks with the largest weight of each term."""

    def __init__(self, examples: list[dict[str, int]], block: int = BLOCK):
        held = Counter(t for e in examples for t in e)
        self.idf = {t: float(np.log(1 + len(examples) / n)) for t, n in held.items()}
        self.block, self.size = block, len(examples)
        self.blocks: list[dict[str, tuple[np.ndarray, np.ndarray]]] = []
        most: dict[str, list[tuple[int, float]]] = {}
        for base in range(0, len(examples), block):
            postings: dict[str, list[tuple[int, float]]] = {}
            for k, example in enumerate(examples[base : base + block]):
                for term, weight in self.vector(example).items():
                    postings.setdefault(term, []).append((k, weight))
            self.blocks.append({t: (np.array([k for k, _ in p]), np.array([w for _, w in p])) for t, p in postings.items()})
            for term, p in postings.items():
                most.setdefault(term, []).append((base // block, max(w for _, w in p)))
        self.most = {t: (np.array([b for b, _ in p]), np.array([w for _, w in p])) for t, p in most.items()}

    def vector(self, counts: dict[str, int]) -> dict[str, float]:
        raw = {t: (1 + np.log(n)) * self.idf[t] for t, n in counts.items() if t in self.idf}
        norm = np.sqrt(sum(w * w for w in raw.values()))
        return {t: w / norm for t, w in sorted(raw.items())} if norm else {}

    def nearest(self, counts: dict[str, int], k: int = NEIGHBOURS, without: int = -1) -> list[tuple[float, int]]:
        """The ``k`` examples of highest positive cosine, the earlier one first among equals; ``without`` is left out."""
        query = self.vector(counts)
        bound = np.zeros(len(self.blocks))
        for term, weight in query.items():
            where, largest = self.most[term]
            bound[where] += weight * largest
        scores, who = np.zeros(0), np.zeros(0, np.int64)
        for b in np.argsort(-bound, kind="stable").tolist():
            least = scores[-1] if len(scores) == k else 0.0
            if bound[b] <= 0 or bound[b] < least - 1e-9:
                break
            score = np.zeros(self.block)
            for term, weight in query.items():
                held = self.blocks[b].get(term)
                if held:
                    score[held[0]] += weight * held[1]
            score = np.round(score, 12)
            found = np.flatnonzero((score > 0) & (score >= least))
            found = found[found + b * self.block != without]
            scores, who = np.concatenate([scores, score[found]]), np.concatenate([who, found + b * self.block])
            first = np.lexsort((who, -scores))[:k]
            scores, who = scores[first], who[first]
        return list(zip(scores.tolist(), who.tolist()))


def monotone(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vote, probability) steps of the isotonic fit, each step smoothed by one example of either label."""
    steps: list[list[float]] = []  # sum of labels, number, least vote
    order = np.argsort(votes, kind="stable")
    for v, y in zip(votes[order].tolist(), labels[order].tolist()):
        if steps and steps[-1][2] == v:
            steps[-1][0] += y
            steps[-1][1] += 1
        else:
            steps.append([y, 1, v])
        while len(steps) > 1 and steps[-2][0] / steps[-2][1] >= steps[-1][0] / steps[-1][1]:
            s, n, _ = steps.pop()
            steps[-1][0] += s
            steps[-1][1] += n
    chance = np.maximum.accumulate(np.array([(s + 1) / (n + 2) for s, n, _ in steps]))
    return np.array([v for _, _, v in steps]), chance


class Model:
    """Examples with their ids and labels; without examples every score is one half."""

    def __init__(self, ids: list[int], labels: np.ndarray, examples: list[dict[str, int]]):
        labels = np.asarray(labels, float)
        bare = np.array([not e for e in examples], bool)
        # No neighbour at all: the share of ones among the examples without any term.
        self.prior = (float(labels[bare].sum()) + 1) / (int(bare.sum()) + 2)
        keep = np.flatnonzero(~bare).tolist()
        self.ids, self.labels = [ids[k] for k in keep], labels[keep]
        self.index = BlockMaxIndex([examples[k] for k in keep])
        self.terms = frozenset(self.index.idf)
        self.judged: dict[tuple, tuple[float, list[dict]]] = {}
        votes, truth = [], []
        step = max(1, -(-len(keep) // CALIBRATED))
        for n, k in list(enumerate(keep))[::step]:
            found = self.index.nearest(examples[k], without=n)
            if found:
                votes.append(self.vote(found))
                truth.append(labels[k])
        self.steps, self.chance = monotone(np.array(votes), np.array(truth)) if votes else (np.zeros(1), np.full(1, 0.5))

    def vote(self, found: list[tuple[float, int]]) -> float:
        weights = np.array([s**SHARPNESS for s, _ in found])
        return round(float(weights @ self.labels[[k for _, k in found]] / weights.sum()), 12)

    def judge(self, text: str | None) -> tuple[float, list[dict]]:
        """(score, evidence) of a text: nearest examples with their cosine and label."""
        counts = terms_of(text, self.terms)
        if not counts:
            return self.prior, []
        key = tuple(sorted(counts.items()))
        if key not in self.judged:
            if len(self.judged) >= REMEMBERED:
                self.judged.clear()
            self.judged[key] = self._judge(counts)
        return self.judged[key]

    def _judge(self, counts: dict[str, int]) -> tuple[float, list[dict]]:
        found = self.index.nearest(counts)
        step = int(np.searchsorted(self.steps, self.vote(found), "right")) - 1
        return float(self.chance[max(0, step)]), [{"id": self.ids[k], "cosine": s, "label": int(self.labels[k])} for s, k in found[:3]]


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Examples from the documents that ``labels`` (``id_col``, y) names, whose number the caller bounds.

    Terms are counted in the tasks and chosen by Spark; the driver gets the chosen ones and their counts per example.
    """
    ready(documents.sparkSession)
    chosen = cut_lineage(documents.select(id_col, text_col).join(F.broadcast(labels), id_col).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), "y"))
    size = chosen.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("ones")).first()
    n, share = size["n"], size["ones"] / max(1, size["n"])
    if not n or not 0 < share < 1:
        return Model([], np.zeros(0), [])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held, ones = Counter(), Counter()
            for text, y in zip(batch["text"], batch["y"]):
                own = terms_of(text).keys()
                held.update(own)
                if y > 0.5:
                    ones.update(own)
            yield pd.DataFrame({"term": list(held), "held": list(held.values()), "ones": [ones[t] for t in held]})

    sums = chosen.mapInPandas(count, "term string, held long, ones long").groupBy("term").agg(F.sum("held").alias("held"), F.sum("ones").alias("ones"))
    surprise = (F.col("ones") - share * F.col("held")) / F.sqrt(F.col("held") * share * (1 - share))
    terms = sums.where(F.col("held") >= LEAST_HELD).withColumn("z", surprise).where(F.col("z") >= SURPRISE).orderBy(F.desc("z"), "term").limit(MOST_TERMS)
    known = frozenset(r["term"] for r in terms.collect())

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = [terms_of(x, known) for x in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "y": batch["y"], "terms": [list(c) for c in counts], "counts": [list(c.values()) for c in counts]})

    rows = chosen.mapInPandas(vectors, "id long, y double, terms array<string>, counts array<long>").orderBy("id").collect()
    return Model([r["id"] for r in rows], np.array([r["y"] for r in rows]), [dict(zip(r["terms"], r["counts"])) for r in rows])


EVIDENCE = ArrayType(StructType([StructField("id", LongType()), StructField("cosine", DoubleType()), StructField("label", LongType())]))
RESULT = StructType([StructField("score", DoubleType()), StructField("evidence", EVIDENCE)])


def toxicity(df: DataFrame, model: Model, text_col: str = "text", output: str = "toxicity") -> DataFrame:
    """``df`` with a struct ``output``: score (0 to 1) and evidence (nearest examples) for every whole text.

    A text without any term of the model, so also a null or empty one, has no neighbours and gets the share of ones
    among such examples. A column named like ``output`` is replaced. The model is bounded by its number of examples.
    """
    shared = ready(df.sparkSession).sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.judge(t) for t in texts], columns=["score", "evidence"])

    return df.withColumn(output, judge(F.col(text_col)))
