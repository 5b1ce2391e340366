"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of 128 words. Each passage is encoded by a small network from
counts that are taken for all passages of a batch at once; a gated attention (tanh times sigmoid)
learned from document labels weighs the passages, and the weighted mean is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sightline.llm.common import ready
from sightline.llm.rolling import Texts, chunks, mix, seen_before

PASSAGE_WORDS = 128
TRAIN_DOCUMENTS = 3_000  # labelled documents a model is fitted on, at most
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"#*$%&", b"|<>{}[]\\/=_~^@", b"!?", b".,;:", b"'\"()-", b"\n", b" \t\r\x0b\x0c")
N_FEATURES = len(CLASSES) + 12


def _class_of() -> np.ndarray:
    table = np.full(256, len(CLASSES), np.uint8)  # all else: beyond ASCII and control characters
    for k, members in enumerate(CLASSES):
        table[np.frombuffer(members, np.uint8)] = k
    return table


_CLASS = _class_of()
def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, number of passages of each text); a text without words is one passage of zeros."""
    own = Texts(texts)
    data, begin, sizes, start, end, doc, words, place = own.data, own.begin, own.sizes + 1, own.start, own.end, own.doc, own.words, own.place
    count = np.maximum(1, -(-words // PASSAGE_WORDS))
    out = np.zeros((int(count.sum()), N_FEATURES), np.float32)
    if not len(start):
        return out, count
    base = np.cumsum(count) - count
    passage = base[doc] + place // PASSAGE_WORDS
    heads = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    rows = passage[heads]
    n = np.diff(np.r_[heads, len(start)])
    # A passage takes the bytes from its first word to the next passage or the end of its text.
    left = start[heads]
    right = np.minimum(np.r_[left[1:], len(data)], (begin + sizes)[doc[heads]])
    kinds = _CLASS[data]
    size = np.maximum(1, right - left)
    for k in range(len(CLASSES) + 1):
        total = np.concatenate([[0], np.cumsum(kinds == k, dtype=np.int32)])
        out[rows, k] = (total[right] - total[left]) / size
    length = end - start
    value = own.hashes(start, end)
    mean = lambda x: np.add.reduceat(x.astype(np.float64), heads) / n
    last = data[end - 1]
    head = data[start]
    two, three = np.zeros(len(start), bool), np.zeros(len(start), bool)
    two[1:] = value[1:] == value[:-1]
    at, triple = own.grams(value, 3)
    three[at + 2] = seen_before(triple)
    k = len(CLASSES) + 1
    for column in (
        mean(length) / 10,
        mean(length > 12),
        mean(length < 3),
        mean(seen_before(mix(value + passage.astype(np.uint64)))),
        mean(seen_before(mix(value + doc.astype(np.uint64)))),
        mean(two & (place > 0)),
        mean(three),
        mean((_CLASS[last] == 3) | (_CLASS[last] == 4) | (_CLASS[last] == 5)),
        mean(_CLASS[head] == 0),
        np.log1p(n) / 5,
        np.log1p(words[doc[heads]]) / 8,
    ):
        out[rows, k] = column
        k += 1
    return out, count


@dataclass
class Attention:
    """The learned weights; ``weights`` is None where nothing could be learned, then ``prior`` is every score."""

    prior: float
    weights: dict[str, np.ndarray] | None = None

    def scores(self, features: np.ndarray, count: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(count), self.prior)
        return _forward(self.weights, (features - self.weights["mean"]) / self.weights["scale"], count)["p"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(w: dict, x: np.ndarray, count: np.ndarray) -> dict:
    heads = np.cumsum(count) - count
    h = np.tanh(x @ w["enc"] + w["enc0"])
    a, g = np.tanh(h @ w["v"]), _sigmoid(h @ w["u"])
    e = (a * g) @ w["att"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, heads), count))
    alpha = e / np.repeat(np.add.reduceat(e, heads), count)
    z = np.add.reduceat(alpha[:, None] * h, heads)
    return {"heads": heads, "h": h, "a": a, "g": g, "alpha": alpha, "z": z, "p": _sigmoid(z @ w["out"] + w["out0"])}


def fit(features: np.ndarray, count: np.ndarray, y: np.ndarray, width: int = 24, gates: int = 12, steps: int = 150, seed: int = 7) -> Attention:
    """Fit by full-batch Adam on the log loss; a smoothed share of ones where a class is missing."""
    prior = (float(y.sum()) + 1) / (len(y) + 2)
    if len(np.unique(y)) < 2:
        return Attention(prior)
    rng = np.random.default_rng(seed)
    mean, scale = features.mean(0), features.std(0) + 0.02
    x = ((features - mean) / scale).astype(np.float64)
    f = x.shape[1]
    w = {
        "enc": rng.normal(0, f**-0.5, (f, width)), "enc0": np.zeros(width),
        "v": rng.normal(0, width**-0.5, (width, gates)), "u": rng.normal(0, width**-0.5, (width, gates)),
        "att": rng.normal(0, 0.1, gates), "out": np.zeros(width), "out0": np.array(np.log(prior / (1 - prior))),
    }
    m, v = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}
    for t in range(1, steps + 1):
        s = _forward(w, x, count)
        ds = (s["p"] - y) / len(y)
        dz = np.repeat(ds[:, None] * w["out"], count, axis=0)
        dalpha = (dz * s["h"]).sum(1)
        de = s["alpha"] * (dalpha - np.repeat(np.add.reduceat(s["alpha"] * dalpha, s["heads"]), count))
        gate = de[:, None] * w["att"]
        da, dg = gate * s["g"] * (1 - s["a"] ** 2), gate * s["a"] * s["g"] * (1 - s["g"])
        dh = (s["alpha"][:, None] * dz + da @ w["v"].T + dg @ w["u"].T) * (1 - s["h"] ** 2)
        grads = {
            "enc": x.T @ dh + 1e-4 * w["enc"], "enc0": dh.sum(0), "v": s["h"].T @ da, "u": s["h"].T @ dg,
            "att": (s["a"] * s["g"]).T @ de, "out": s["z"].T @ ds + 1e-4 * w["out"], "out0": ds.sum(),
        }
        for k, g in grads.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = w[k] - 0.02 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return Attention(prior, {**w, "mean": mean, "scale": scale})


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Attention:
    """Fit on the documents that ``labels`` (``id_col``, y) names, whose number the caller bounds.

    Only counts per passage come to the driver. Null texts count as empty, documents without a row are skipped.
    """
    ready(documents.sparkSession)
    chosen = documents.select(id_col, text_col).join(F.broadcast(labels), id_col).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), "y")

    def encode(batches):
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                features, count = passages([t.encode() if t else b"" for t in part["text"]])
                rows = np.split(features, np.cumsum(count)[:-1])
                yield pd.DataFrame({"id": part["id"], "y": part["y"], "features": [r.ravel() for r in rows]})

    id_type = documents.schema[id_col].dataType.simpleString()
    found = chosen.mapInPandas(encode, f"id {id_type}, y double, features array<float>").orderBy("id").toPandas()
    if not len(found):
        return Attention(0.5)
    bags = [np.asarray(f, np.float32).reshape(-1, N_FEATURES) for f in found["features"]]
    return fit(np.concatenate(bags), np.array([len(b) for b in bags]), found["y"].to_numpy() > 0.5)


def quality_scores(df: DataFrame, model: Attention, text_col: str = "text", output: str = "score") -> DataFrame:
    """``df`` with the probability of label 1 for every whole text.

    Null, empty and wordless texts are bags of one blank passage. A column named like ``output`` is replaced.
    """
    ready(df.sparkSession)

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        parts = [model.scores(*passages(chunk)) for chunk in chunks(texts)]
        return pd.Series(np.concatenate([np.zeros(0), *parts]))

    return df.withColumn(output, score(F.col(text_col)))
