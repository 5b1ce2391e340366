"""Rolling hashes over the words and lines of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
CHUNK_BYTES = 1 << 18  # the arrays of a chunk stay in the cache


def chunks(texts: Iterable[str | None], most: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """Texts as bytes, null as empty, in chunks of about ``most`` bytes; a longer text is a chunk of its own."""
    chunk, size = [], 0
    for text in texts:
        raw = text.encode() if text else b""
        if chunk and size + len(raw) > most:
            yield chunk
            chunk, size = [], 0
        chunk.append(raw)
        size += len(raw)
    if chunk:
        yield chunk


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Texts:
    """A chunk of texts: bytes, words, lines and the hash of any stretch of bytes from prefix sums.

    The hash is a polynomial modulo 2^64 with an odd base, mixed afterwards; equal hashes are taken as equal text.
    """

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.begin = np.cumsum(self.sizes + 1) - self.sizes - 1
        blank = BLANK[self.data]
        self.start = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
        self.end = np.flatnonzero(~blank & np.r_[blank[1:], True]) + 1
        self.doc = np.searchsorted(self.begin, self.start, "right") - 1
        self.words = np.bincount(self.doc, minlength=len(texts))
        self.place = np.arange(len(self.start)) - (np.cumsum(self.words) - self.words)[self.doc]
        n = len(self.data)
        ones = np.ones(1, np.uint64)
        power = np.cumprod(np.concatenate([ones, np.full(n - 1, BASE, np.uint64)]), dtype=np.uint64)
        self.back = np.cumprod(np.concatenate([ones, np.full(n, INVERSE, np.uint64)]), dtype=np.uint64)
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.data.astype(np.uint64) + ones) * power, dtype=np.uint64)])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.back[start])

    def grams(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, key) of all ``n``-word windows inside one text; the key includes the text's number."""
        at = np.flatnonzero(self.place + n <= self.words[self.doc])
        key = self.doc[at].astype(np.uint64)
        for k in range(n):
            key = key * np.uint64(BASE) + words[at + k]
        return at, mix(key)

    def per_text(self, values: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return np.bincount(owner, values, minlength=len(self.sizes)).astype(np.int64)


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    order = np.argsort(keys)
    same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    out = np.zeros(len(keys), bool)
    out[order[same]] = True
    out[order[same + 1]] = True
    return out


def seen_before(keys: np.ndarray) -> np.ndarray:
    """True for all but the first of equal keys."""
    out = np.ones(len(keys), bool)
    out[np.unique(keys, return_index=True)[1]] = False
    return out
