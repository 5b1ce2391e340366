"""Phrases, repeated word windows and fill-in-the-middle examples against plain versions of the same contracts."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.llm import countmin, infill, phrases, repetition
from tests.llm.test_operators import CLASHES, SCHEMA, by_id, docs, messy, nothing, prose  # noqa: F401

MORE_CLASHES = ("n", "form", "infill", "rank", "phrase", "f", "bar", "data", "kind", "n_words", "cells")


@pytest.fixture()
def clashing(docs):  # noqa: F811
    for name in MORE_CLASHES:
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


# ---------------------------------------------------------------- 11 phrases


def plain_phrases(rows, top, least=10, swallowed=50):
    words, counts = Counter(), defaultdict(Counter)
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(w)
            for n in (1, 2, 3):
                counts[lang].update(" ".join(w[k : k + n]) for k in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if a >= least and p.count(" ") in (1, 2)}
        kept = []
        for p, a in found.items():
            longer = [b for q, b in found.items() if q.count(" ") > p.count(" ") and f" {p} " in f" {q} "]
            if any(100 * b >= swallowed * a for b in longer):
                continue
            w = p.split()
            cuts = [(1_000_000 * a * a // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            kept.append((-score, -a, p.encode(), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        out += [(lang, r, p.decode(), -a, x, y, words[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def babble(seed, words=60):
    """Few words with habits, so that pairs and triples repeat and swallow each other."""
    rng = random.Random(seed)
    out = []
    for _ in range(words):
        out.append(rng.choice(["New York City", "of the", "a b", "a b", "a", "b", "c d e", "x", "y", "der Ä", "to\tbe", "be or. not", "q,", "q"]))
    return " ".join(out)


@pytest.fixture(scope="module")
def talk():
    rows = [(k, babble(k), ("en", "de", None)[k % 3 if k % 7 else 0], None, None) for k in range(90)]
    return [*rows, rows[0], (None, None, "en", None, None), (91, "", "fr", None, None), (92, " \t. ", "it", None, None), (93, "x y " * 3000, "en", None, None)]


@pytest.mark.parametrize("top", [1, 3, 7, 2000])
def test_phrases_equal_counting_everything(spark, talk, top):
    df = spark.createDataFrame(talk, SCHEMA).repartition(3)
    for name in MORE_CLASHES:
        df = df.withColumn(name, F.lit("clash"))
    got = phrases.collocations(df, top=top, growth=2)
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == plain_phrases(talk, top)


def test_phrases_with_a_crowded_bit_table(spark, talk):
    """Bits set by chance cost work, not results."""
    got = phrases.collocations(spark.createDataFrame(talk, SCHEMA), top=5, filter_bits=15)
    want = plain_phrases(talk, 5)
    assert sorted(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == want


def test_phrase_scores_beyond_64_bits(spark):
    row = spark.range(1).select(phrases._score(*(F.lit(x) for x in (10**12 - 1, 10**12, 10**12 + 7))).alias("s")).first()
    assert row["s"] == 1_000_000 * (10**12 - 1) ** 2 // (10**12 * (10**12 + 7))


def test_phrases_of_nothing(spark, nothing):  # noqa: F811
    assert phrases.collocations(nothing).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, "one two", None, None, None)], SCHEMA)).count() == 0


# ---------------------------------------------------------------- 12 fill in the middle


def plain_infill(i, text):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(h[k : k + 8], 16) for k in range(0, 32, 8)]
    u = re.findall("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+", text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(u), "plain", None, None, text
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h[3] % 100 < 80:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_infill_equals_a_plain_version(spark, clashing, messy):  # noqa: F811
    odd = [(k, t, None, None, None) for k, t in enumerate(["<P> here", "ends with <", " lead", "trail \n\t", "a\x1cb\x85 \xa0c", "𝄞 𝄞𝄞  é́", "x" * 5000 + " y z", "<S", "<", "<<P", "P> <M"] * 30, 100)]
    df = clashing.unionByName(spark.createDataFrame([*odd, (None, "no id at all", None, None, None)], SCHEMA), allowMissingColumns=True)
    got = infill.fill_in_middle(df).select("doc_id", "text", "infill.*").collect()
    want = {(i, t): plain_infill(i, t) for i, t, *_ in [*messy, *odd, (None, "no id at all")]}
    assert len(got) == len(messy) + len(odd) + 1 and {r["form"] for r in got} == {"plain", "spm", "psm"}
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want[r["doc_id"], r["text"]]
        assert r["restored"] == (r["text"] or "")


def test_infill_keeps_other_columns(clashing, nothing):  # noqa: F811
    assert set(infill.fill_in_middle(clashing, output="made").columns) == {*clashing.columns, "made"}
    assert infill.fill_in_middle(nothing).count() == 0


@pytest.mark.parametrize("error", [1, 100, 1000])
def test_rank_index_is_exact_and_bounded(error):
    rng = np.random.default_rng(error)
    for places in (np.zeros(0, np.int64), np.array([7]), np.cumsum(rng.integers(1, 9, 20_000)), np.cumsum(rng.integers(1, 3000, 3000)),
                   np.concatenate([np.arange(500), 10**6 + 5 * np.arange(5000)]), np.arange(10_000) * 10**6):
        index = infill.RankIndex(places, error)
        assert len(index) == len(places) and (not len(places) or np.abs(index.residual).max() <= error + 1)
        assert [index[k] for k in range(0, len(places), 97)] == places[::97].tolist()
    smooth = infill.RankIndex(np.cumsum(rng.integers(1, 12, 50_000)), 100)
    assert len(smooth.first) < 300  # far fewer segments than places


# ---------------------------------------------------------------- 13 repeated windows


def plain_windows(rows, width):
    first, out = {}, []
    split = [(i, re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t, *_ in rows]
    for i, w in split:
        if i is not None:
            for k in range(len(w) - width + 1):
                g = tuple(w[k : k + width])
                first[g] = min(i, first.get(g, i))
    for i, w in split:
        gone = set()
        if i is not None:
            for k in range(len(w) - width + 1):
                if first[tuple(w[k : k + width])] < i:
                    gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("width", "depth"), [(50, 2), (50, 1), (3, 2), (1, 1), (37, 3)])
def test_windows_equal_a_plain_version(clashing, messy, width, depth):  # noqa: F811
    got = countmin.remove_repeated_windows(clashing, width=width, rows=depth)
    assert by_id(got, "n_words", "n_removed", "kept") == plain_windows(messy, width)
    for r in got.collect():
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]
        assert all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:]))


def test_windows_over_many_groups(spark, monkeypatch):
    """Small groups, slices and parts give the same as one of each."""
    for name in ("GROUP_BYTES", "SLICE_BYTES", "PART_BYTES"):
        monkeypatch.setattr(countmin, name, 3000)
    shared = prose(1, 70)
    rows = [(k, " ".join([prose(k), *([shared] * (k % 3 == 0)), prose(k // 10 + 1000)]), None, None, None) for k in range(120)]
    rows += [(None, shared, None, None, None), (-5, shared.upper(), None, None, None), (500, shared, None, None, None), (500, shared, None, None, None)]
    got = countmin.remove_repeated_windows(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert by_id(got, "n_words", "n_removed", "kept") == plain_windows(rows, 50)


def test_window_keys_tell_orders_and_alphabets_apart():
    """Strings over two letters that cheat polynomials modulo 2^64, and permutations, keep keys of their own."""
    bit = np.array([bin(k).count("1") % 2 for k in range(4096)])
    lane = np.array([11, 12], np.uint64)
    assert countmin.window_keys(lane[bit], 4096, 0) != countmin.window_keys(lane[1 - bit], 4096, 0)
    many = np.random.default_rng(1).integers(0, 3, 4000)
    keys = countmin.window_keys(np.array([5, 6, 7], np.uint64)[many], 7, 1)
    assert len(keys) == 3994
    assert len(set(keys.tolist())) == len({tuple(many[k : k + 7]) for k in range(3994)})


def test_windows_need_integer_ids(spark, nothing):  # noqa: F811
    with pytest.raises(TypeError, match="integer"):
        countmin.remove_repeated_windows(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
    assert countmin.remove_repeated_windows(nothing).count() == 0


# ---------------------------------------------------------------- 2 lines that cheat polynomials


def test_lines_of_two_letters_stay_apart():
    bits = [bin(k).count("1") % 2 for k in range(4096)]
    one, other = ("".join(pair[b] for b in bits) for pair in ("ab", "ba"))
    texts = ["\n".join([one, other, "x"]), "\n".join([one, one, other])]
    counts = repetition.repetition_counts([t.encode() for t in texts])
    assert counts["n_dup_lines"].tolist() == [0, 1]
    words = repetition.repetition_counts([" ".join([one, "m", "n", other, "m", "n"]).encode()])
    assert words["n_repeat_words"].tolist() == [0]
