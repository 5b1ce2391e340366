"""Every text operator on a messy little table against a plain version of the same contract."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sightline.llm import automaton, bpe, language, mil, neighbours, repair, repetition, sharding, simhash, suffix
from sightline.llm.common import connected_components, labelled_ids

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("id", "g", "part", "hub", "label", "shard", "slot", "fingerprint", "component_id", "removed", "kept", "hits", "token_ids", "score", "block", "y")


def prose(seed, words=80):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghiklmnopr") for _ in range(rng.randint(2, 8))) for _ in range(words))


@pytest.fixture(scope="module")
def messy():
    shared, long = prose(1, 40), prose(2, 30_000)
    texts = [
        None, "", " \t\n", "short", prose(3), prose(3), prose(3), shared + "\n" + prose(4), prose(5) + " " + shared, prose(6).upper(), long, "vor " + long,
        "é" * 120, "x" + "é" * 120, "日本語のテキスト " * 20, "a a a a " * 40, "line one here\nline one here\n\nline two " * 5, "#*$ %&| <> x\n" * 8, "a\x1cb\x85c\xa0d don't  'll x", "1,2. 3!! \x00 \x7f",
    ]
    rows = [(k, t, "en" if k % 2 else None, None if k % 3 else "src", None) for k, t in enumerate(texts)]
    return rows + [rows[5], (21, prose(3), None, None, 5)]


@pytest.fixture()
def docs(spark, messy):
    df = spark.createDataFrame(messy, SCHEMA).repartition(3)
    for name in CLASHES:
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture()
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *columns):
    return sorted(((r["doc_id"], *(r[c] for c in columns)) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- 9 SimHash


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    values = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def components(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 3:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in prints}


def test_simhash_components_equal_all_pairs(spark, docs, messy):
    prints = {t: fingerprint(t) for t in {r[1] for r in messy}}
    root = components(set(prints.values()))
    least = {}
    for i, t, *_ in messy:
        least[root[prints[t]]] = min(i, least.get(root[prints[t]], i))
    want = sorted(((i, f"{prints[t]:016x}", least[root[prints[t]]]) for i, t, *_ in messy), key=repr)
    found = simhash.simhash_components(docs).withColumn("fingerprint", simhash.hex_digits("fingerprint"))
    assert by_id(found, "fingerprint", "component_id") == want


def test_golay_keys_meet_for_up_to_three_bits():
    rng = random.Random(5)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        key, pos, first = simhash.golay_keys(np.array([a, b], np.uint64).view(np.int64))
        index, search = set(key[(pos == 0) & first].tolist()), set(key[pos == 1].tolist())
        assert index & search


def test_large_key_groups_are_linked_like_all_pairs(spark):
    rng = random.Random(9)
    center = rng.getrandbits(64)
    values = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(400)}
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fingerprint long")
    roots = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in connected_components(simhash.simhash_links(df)).collect()}
    want = components(values)
    groups = lambda m: sorted(sorted(v for v in values if m.get(v, v) == r) for r in {m.get(v, v) for v in values})
    assert groups(roots) == groups(want)


def test_simhash_of_nothing(nothing):
    assert simhash.simhash_components(nothing).count() == 0
    assert simhash.keep_one(nothing).count() == 0


def test_keep_one_keeps_the_least_of_each_group(docs):
    kept = {r["doc_id"] for r in simhash.keep_one(docs).collect()}
    assert {4, 0, 12} <= kept and not kept & {1, 2, 5, 6, 21}


def test_keep_one_links_five_word_shingles_at_four_fifths(spark):
    rng = random.Random(7)
    rows, pairs = [], {}
    for k in range(40):
        words = prose(1000 + k, 300).split()
        copy = list(words)
        for at in rng.sample(range(300), 1 + k % 14):
            copy[at] = f"other{k}x{at}"
        sets = [{tuple(t[a : a + 5]) for a in range(296)} for t in (words, copy)]
        pairs[2 * k + 1] = len(sets[0] & sets[1]) / len(sets[0] | sets[1]) >= 0.8
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
    assert 5 < sum(pairs.values()) < 35
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = {r["doc_id"] for r in simhash.keep_one(df, words=5, similarity=0.8).collect()}
    assert kept == {i for i, _ in rows if not pairs.get(i)}


def test_similar_links_of_a_dense_group_and_of_nothing(spark, nothing):
    base = prose(77, 200).split()
    texts = [" ".join([*base[:k], f"new{k}", *base[k + 1 :]]) for k in range(60)]
    df = spark.createDataFrame([*enumerate(texts), (90, prose(78, 200)), (91, None), (92, " ")], "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.keep_one(df, words=5, similarity=0.8).collect()} == {0, 90, 91}
    assert simhash.keep_one(nothing, words=5, similarity=0.8).count() == 0


def test_pipeline_links_by_fingerprints_and_by_shingles(spark):
    """What op9 puts into one component is one document after the stage, also where the shingles differ too much."""
    import corpus_pipeline

    line = "the same five words again " * 100  # decides the fingerprint, and is five shingles of some forty
    texts = [line + prose(500 + k, 30) for k in range(20)] + [prose(600 + k, 120) for k in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("doc_id", "text", "'en' AS lang", "'web' AS source", "length(text) AS n_chars")
    group = {r["doc_id"]: r["component_id"] for r in simhash.simhash_components(df).collect()}
    assert set(group.values()) == {0, *range(20, 40)}
    assert simhash.keep_one(df, words=5, similarity=0.8).count() == 40
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, df, "").collect()} == set(group.values())
    copies = [(0, prose(1, 300)), (1, prose(1, 300) + " more words at the end"), (2, prose(2, 300))]
    df = spark.createDataFrame(copies, "doc_id long, text string").selectExpr("doc_id", "text", "'en' AS lang", "'web' AS source", "length(text) AS n_chars")
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, df, "").collect()} == {0, 2}


@pytest.mark.parametrize("names", [{}, {"words": 5, "similarity": 0.8}, {"words": 5, "similarity": 0.8, "fingerprint_words": 3}])
def test_keep_one_of_rows_without_id_and_of_repeated_ids(spark, names):
    a, b, c, d = (prose(k) for k in range(300, 304))
    rows = [(None, a), (None, b), (None, b), (None, c), (9, c), (4, d), (4, prose(304)), (4, d)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), **names).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted({(None, a), (None, b), (9, c), (4, d), (4, prose(304))}, key=repr)


# ---------------------------------------------------------------- 3 suffix arrays


@pytest.mark.parametrize("most", [1, 900, 1 << 40, 1 << 62])
def test_names_are_sorted_in_one_number_with_their_place(most):
    """Also where value and place do not fit one number."""
    values = np.random.default_rng(3).integers(0, most, 5000, endpoint=True)
    order, ordered = suffix.sorted_order(values, most)
    assert np.array_equal(order, np.argsort(values, kind="stable")) and np.array_equal(ordered, np.sort(values))


def test_documents_of_an_anchor_are_counted_once():
    texts = [b"the very same sentence in many documents, again and again; " * n for n in (1, 3, 2)] + [b""]
    group = suffix._Group(pa.table([pa.array([5, 3, 9, 1]), pa.array(texts)], names=["id", "text"]), 50, 1)
    pairs = {(a, d) for a, d in zip(group.which.tolist(), group.doc.tolist())}
    assert group.documents_per_anchor().tolist() == [sum(a == k for a, _ in pairs) for k in range(len(group.anchors))]


def cut(rows, width=50):
    rows = [(i, (t or "").encode()) for i, t, *_ in rows]
    first = {}
    for i, t in sorted(rows):
        for p in range(len(t) - width + 1):
            first.setdefault(t[p : p + width], i)
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - width + 1):
            if first[t[p : p + width]] < i:
                gone[p : p + width] = b"\1" * width
        runs = [{"start": m.start(), "end": m.end()} for m in re.finditer(b"\1+", gone)]
        out.append((i, len(t), runs, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [5_000, 2])
def test_repeats_equal_brute_force(docs, messy, hot, monkeypatch):
    monkeypatch.setattr(suffix, "GROUP_BYTES", 20_000)
    monkeypatch.setattr(suffix, "SHARD_BYTES", 20_000)
    found = suffix.remove_repeats(docs, hot_documents=hot)
    got = [(r["doc_id"], r["n_bytes"], [s.asDict() for s in r["removed"]], bytes(r["kept"])) for r in found.collect()]
    assert sorted(got, key=repr) == cut(messy)


def test_repeats_of_given_documents(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = [(r["doc_id"], r["n_bytes"], [s.asDict() for s in r["removed"]], bytes(r["kept"])) for r in suffix.remove_repeats(df).collect()]
    assert sorted(got, key=repr) == cut(rows)


def test_whole_characters_stay_valid(docs):
    for r in suffix.remove_repeats(docs, whole_characters=True).collect():
        bytes(r["kept"]).decode()


def test_null_ids_match_nothing(spark):
    df = spark.createDataFrame([(None, prose(1)), (None, prose(1)), (7, prose(1)), (8, prose(1))], "doc_id long, text string")
    assert sorted(((r["doc_id"], len(r["removed"])) for r in suffix.remove_repeats(df).collect()), key=repr) == [(7, 0), (8, 1), (None, 0), (None, 0)]


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 17, 400):
        for letters in (1, 2, 4, 200):
            text = rng.integers(0, letters, n).astype(np.uint8)
            raw = text.tobytes()
            assert suffix.suffix_array(text).tolist() == sorted(range(n), key=lambda i: raw[i:])


def test_repeats_of_nothing(nothing):
    assert suffix.remove_repeats(nothing).count() == 0


# ---------------------------------------------------------------- 4 BPE

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def test_bpe_equals_the_library_at_any_leaf_size():
    own = bpe.Codec(*RANKS)
    library = tiktoken.Encoding("own", pat_str=RANKS[1], mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(3)
    for leaf in (1, 2, 3, 7):
        own.leaf = leaf
        for k in range(400):
            text = "".join(rng.choice("ab'stre l\n\t　\x1cé中1½-!" if k % 2 else "'tre l\n ") for _ in range(rng.randint(0, 50)))
            assert own.encode(text).tolist() == library.encode_ordinary(text), (leaf, text)


def test_bpe_there_and_back(docs, messy, nothing):
    library = tiktoken.Encoding("own", pat_str=RANKS[1], mergeable_ranks=bpe.Codec(*RANKS).ranks, special_tokens={})
    coded = bpe.decode_documents(bpe.encode_documents(docs, *RANKS), *RANKS)
    want = sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in messy), key=repr)
    assert sorted(((r["doc_id"], list(r["token_ids"]), bytes(r["decoded"])) for r in coded.collect()), key=repr) == want
    at_once = bpe.encode_and_decode(docs, *RANKS).select("doc_id", "coded.*")
    assert sorted(((r["doc_id"], list(r["token_ids"]), bytes(r["decoded"])) for r in at_once.collect()), key=repr) == want
    assert bpe.decode_documents(bpe.encode_documents(nothing, *RANKS), *RANKS).count() == 0


# ---------------------------------------------------------------- 5 decontamination


def normal(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def hits_of(text, items):
    words, hit, names = normal(text), set(), set()
    for item, other in items:
        other = normal(other)
        for k in range(max(1, len(other) - 9)) if other else ():
            window = other[k : k + 10]
            for p in range(len(words) - len(window) + 1):
                if words[p : p + len(window)] == window:
                    hit |= set(range(p, p + len(window)))
                    names.add(str(item))
    return len(words), sorted(hit), sorted(names)


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_hits_equal_brute_force(spark, docs, messy, block):
    p = prose(4).split()
    items = [(1, " ".join(p[3:30])), (2, None), (3, ""), (4, "line two"), (5, "one here"), (6, " ".join(p[10:19])), (7, "ONE, here! line"), (8, " ".join(p[3:30])), (9, "x"), (10, prose(2, 30_000)[5000:5600])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = automaton.benchmark_hits(docs, bench, block_bytes=block).collect()
    got = sorted(((r["doc_id"], r["hits"]["n_words"], [k for s in r["hits"]["spans"] for k in range(s["start"], s["end"])], list(r["hits"]["items"])) for r in found), key=repr)
    assert got == sorted(((i, *hits_of(t, items)) for i, t, *_ in messy), key=repr)


def test_no_benchmark_hits_nothing(spark, docs, nothing):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert automaton.benchmark_hits(docs, bench).where(F.size("hits.items") > 0).count() == 0
    assert automaton.benchmark_hits(nothing, bench).count() == 0


def test_removed_hits_leave_the_rest(spark):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    df = spark.createDataFrame([(1, "Zero. ONE, two: three! four five six"), (2, "one two three"), (3, None)], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in automaton.remove_hits(automaton.benchmark_hits(df, bench, rest=True)).collect()}
    assert out == {1: "Zero. ! four five six", 3: None}


# ---------------------------------------------------------------- 2 repetition


def counts_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")

    def covered(n):
        grams = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]
        often = Counter(grams)
        return {k + j for k, g in enumerate(grams) if often[g] > 1 for j in range(n)}

    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    again = [x for k, x in enumerate(lines) if x in lines[:k]]
    base = [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(again), len(covered(3))]
    return tuple(base + [sum(len(w) for x in again for w in re.findall(r"[^\x20\x09-\x0D]+", x))] + [sum(len(words[k]) for k in covered(n)) for n in repetition.LENGTHS])


def test_repetition_counts_equal_brute_force(docs, messy, nothing):
    found = repetition.repetition_rules(docs).select("doc_id", "repetition.*")
    got = by_id(found, *repetition.COUNTS)
    assert got == sorted(((i, *counts_of(t)) for i, t, *_ in messy), key=repr)
    assert repetition.repetition_rules(nothing).count() == 0
    kept = {r["doc_id"] for r in found.where("kept").collect()}
    assert 4 in kept and 15 not in kept and 0 not in kept


# ---------------------------------------------------------------- 6 language


def test_language_of_words_grams_and_nothing(spark, nothing):
    train = [("en", "the house of the rising sun and the words thereof")] * 5 + [("de", "das haus der aufgehenden sonne und die schönen wörter")] * 5 + [(None, "x"), ("fr", None)]
    model = language.train(spark.createDataFrame(train, "lang string, text string"))
    df = spark.createDataFrame([(1, "THE house"), (2, "sonne"), (3, None), (4, ""), (5, "123 !? _"), (6, "schönes"), (7, "ngth")], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r["language"]) for r in language.predict_languages(df, model).collect()}
    assert [got[k][0] for k in range(1, 8)] == ["en", "de", "und", "und", "und", "de", got[7][0]]
    assert all(0 <= s <= 1 for _, s in got.values()) and got[3][1] == 0
    empty = language.train(nothing)
    assert {r["language"]["lang_pred"] for r in language.predict_languages(df, empty).collect()} == {"und"}
    assert language.predict_languages(nothing, model).count() == 0


def test_language_of_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(df.where("doc_id % 4 <> 2"))
    found = language.predict_languages(df.where("doc_id % 4 = 2"), model)
    assert found.where("lang = language.lang_pred").count() / found.count() > 0.95


def test_a_rare_language_keeps_its_words(spark):
    rng = random.Random(9)

    def text(alphabet, seed, words):
        vocabulary = ["".join(random.Random(seed + k).choices(alphabet, k=6)) for k in range(400)]
        return " ".join([*rng.choices(vocabulary, k=words), *["shared"] * 3])

    rows = [("common", text("abcdefgh", 0, 300)) for _ in range(297)] + [("rare", text("efghijkl", 1000, 300)) for _ in range(3)]
    train = spark.createDataFrame(rows, "lang string, text string")
    model = language.train(train, most_words=100)
    seen = {lang: Counter(w for x, t in rows if x == lang for w in t.split()) for lang in ("common", "rare")}
    best = {w for c in seen.values() for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:100]}
    assert {w for w in model.row if w.isalpha()} == best and len(best) == 199
    weights = model.weights[model.row["shared"]]  # counted in full on both sides
    total = [sum(c[w] for w in best) for c in (seen["common"], seen["rare"])]
    assert weights == pytest.approx([np.log((n + 0.5) / (t + 0.5 * 199)) for n, t in zip((297 * 3, 9), total)])
    held = spark.createDataFrame([("common", text("abcdefgh", 0, 40)) for _ in range(20)] + [("rare", text("efghijkl", 1000, 40)) for _ in range(20)], train.schema)
    assert language.predict_languages(held, model).where("lang <> language.lang_pred").count() == 0


def test_backoff_takes_the_longest_known_grams():
    model = language.Model([("a", "abcdefg", 5), ("b", "vwxyz", 5)])
    assert len(model.rows_of("abcdefg")) == 1
    rows = {v: k for k, v in model.row.items()}
    assert {rows[k][0] for k in model.rows_of("abcdxxx")} == {"5"} and {rows[k][0] for k in model.rows_of("qqab")} == {"2"}
    assert model.rows_of("qqq") == ()


# ---------------------------------------------------------------- 7 quality and 1 toxicity


def held_out(spark, train, score, label, **names):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = train(docs, labelled_ids(labels, label, 5, 0, 2500))
    rest = docs.join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    return score(rest, model).toPandas()


def test_quality_on_held_out_documents(spark):
    found = held_out(spark, mil.train, mil.quality_scores, "quality")
    assert ((found["score"] >= 0.3) == (found["quality"] == 1)).mean() > 0.95


def test_toxicity_on_held_out_documents(spark):
    found = held_out(spark, neighbours.train, neighbours.toxicity, "toxic")
    score = found["toxicity"].map(lambda r: r["score"])
    assert (score[found["toxic"] == 1] >= 0.7).mean() > 0.75 and (score[found["toxic"] == 0] >= 0.7).mean() < 0.03


def test_scores_of_messy_documents(spark, docs, messy, nothing):
    labels = spark.createDataFrame([(i, float(i % 2)) for i in range(25)] + [(99, 1.0)], "doc_id long, y double")
    for train, score in ((mil.train, lambda d, m: mil.quality_scores(d, m)), (neighbours.train, lambda d, m: neighbours.toxicity(d, m, output="t").withColumn("score", F.col("t.score")))):
        model = train(docs, labels)
        values = [r["score"] for r in score(docs, model).collect()]
        assert len(values) == len(messy) and all(0 <= v <= 1 for v in values)
        assert score(nothing, model).count() == 0
        flat = {r["score"] for r in score(docs, train(nothing, labels)).collect()}
        assert flat == {0.5}
        one = train(docs, labels.withColumn("y", F.lit(1.0)))
        assert all(0 <= r["score"] <= 1 for r in score(docs, one).collect())


def test_labels_are_bounded_and_skip_the_fold(spark):
    rows = [(i, i % 2) for i in range(200)] + [(3, 0), (4, None), (None, 1)]
    got = labelled_ids(spark.createDataFrame(rows, "doc_id long, toxic int"), "toxic", 3, 1, 50).collect()
    assert len(got) == 50 and all(zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 for r in got)


def test_passage_attention_sees_the_one_bad_passage():
    good, bad = prose(11, 900), ("spam " * 128)
    texts = [(good + " " + prose(k, 128 * (k % 4))).encode() for k in range(40)] + [(prose(k, 128 * (k % 4)) + " " + bad).encode() for k in range(40)]
    y = np.array([1.0] * 40 + [0.0] * 40)
    features, count = mil.passages(texts)
    model = mil.fit(features, count, y)
    assert ((model.scores(features, count) > 0.5) == (y == 1)).all()


def test_nearest_equals_all_cosines():
    rng = random.Random(2)
    examples = [{f"t{k}": rng.randint(1, 4) for k in rng.sample(range(60), rng.randint(1, 6))} for _ in range(300)]
    index = neighbours.BlockMaxIndex(examples, block=16)
    vectors = [index.vector(e) for e in examples]
    for _ in range(50):
        query = {f"t{k}": rng.randint(1, 4) for k in rng.sample(range(70), 4)}
        q = index.vector(query)
        every = [(round(sum(w * v.get(t, 0) for t, w in q.items()), 10), k) for k, v in enumerate(vectors)]
        want = sorted((s for s, _ in every if s > 0), reverse=True)[:9]
        assert [round(s, 10) for s, _ in index.nearest(query, 9)] == want


def test_monotone_probabilities():
    at, chance = neighbours.monotone(np.array([0, 0.2, 0.2, 0.5, 0.9, 1.0]), np.array([0, 1, 0, 0, 1, 1]))
    assert (np.diff(at) > 0).all() and (np.diff(chance) >= 0).all()


# ---------------------------------------------------------------- 8 sharding


def test_shards_are_even_gapless_and_keep_groups(spark, docs, messy, nothing):
    got = sharding.balanced_shards(docs, 4).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, *_ in messy)
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(4))
    for shard in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sizes[shard]))
    texts = {i: t for i, t, *_ in messy}
    for r in got:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
    assert len({r["shard"] for r in got if r["doc_id"] in (4, 5, 6, 21)}) == 1
    assert sharding.balanced_shards(nothing, 4).count() == 0


def test_a_group_of_a_third_spreads_evenly(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'same' WHEN id % 3 = 1 THEN concat('pair ', id div 6) ELSE concat('own ', id) END AS text")
    got = sharding.balanced_shards(df, 24).join(df, "doc_id").toPandas()
    assert got.groupby("shard").size().tolist() == [125] * 24
    pairs = got[got.text.str.startswith("pair")].groupby("text")["shard"].agg(["size", "nunique"])
    assert (pairs[pairs["size"] > 1]["nunique"] == 1).mean() > 0.9


@pytest.mark.parametrize("size", [2, 10])
def test_groups_keep_together_in_full_shards(spark, size):
    df = spark.range(4800).selectExpr("id AS doc_id", f"concat('group ', id % {4800 // size}) AS text")
    got = sharding.balanced_shards(df, 24).join(df, "doc_id").toPandas()
    assert got.groupby("shard").size().tolist() == [200] * 24
    assert got.groupby(["text", "shard"]).size().groupby("text").max().sum() > 0.95 * 4800


def test_cut_links_never_grow_and_full_shards_swap(spark):
    """All shards are full from the start and each group is scattered: only swaps can gather it."""
    now = spark.range(2400).selectExpr("id", "pmod(xxhash64(id), 400) AS hub", "cast(id % 8 AS int) AS label").cache()

    def state(df):
        held = df.groupBy("hub", "label").count().toPandas()
        return sum(n * n for n in held["count"]), held.groupby("label")["count"].sum().max()

    kept, _ = first = state(now)
    for _ in range(4):
        now = sharding.propagated(now, 300, 1)
        after, fullest = state(now)
        assert after >= kept and fullest < 400
        kept = after
    assert kept > 1.5 * first[0]


def test_grants_swap_what_is_asked_both_ways(spark):
    asked = spark.createDataFrame([(0, 0, 90), (0, 1, 10), (1, 0, 4), (1, 1, 93), (2, 0, 5)], "label int, wanted int, n long")
    got = {(r["label"], r["wanted"]): r["share"] for r in sharding.grants(asked, 100).collect()}
    assert got[0, 1] == pytest.approx((4 + 6 * 0.5) / 10) and got[1, 0] == 1 and got[2, 0] == 0
    assert sharding.grants(asked.limit(0), 100).count() == 0


@pytest.mark.parametrize("size", [2, 10])
def test_groups_start_scattered_and_propagation_gathers_them(spark, size):
    """Every document starts on a label of its own, so what is together in the end was brought together by the rounds."""
    linked = spark.range(4800).selectExpr("id", f"pmod(xxhash64(id % {4800 // size}), 1000000007) AS hub", f"{size}L AS members")
    start = sharding.started(linked, 24, 4800)

    def together(df):
        return df.groupBy("hub", "label").count().toPandas().groupby("hub")["count"].max().sum() / 4800

    got = sharding.propagated(start, 200, 5).cache()
    assert together(start) < 0.6 and together(got) > 0.95
    assert got.groupBy("label").count().toPandas()["count"].max() < 300


def test_labels_let_in_what_leaves_and_fits():
    assert sharding.admitted([(0, 1, 10), (1, 2, 10), (2, 0, 10)], 10) == {0: 1.0, 1: 1.0, 2: 1.0}  # round in a circle
    assert sharding.admitted([(0, 1, 10), (1, 0, 5), (1, 1, 5)], 10) == {0: 1.0, 1: 0.5}
    got = sharding.admitted([(0, 1, 10), (1, 2, 10), (2, 2, 10), (3, 3, 4), (0, 3, 12)], 10)
    assert got == {1: 0.0, 2: 0.0, 3: 0.5}


# ---------------------------------------------------------------- 10 token files

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_token_files_there_and_back(spark, docs, messy, nothing, tmp_path):
    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    repair.write_token_files(docs, WORDS, f"{tmp_path}/a", block_tokens=300)
    got = {}
    for r in repair.read_token_files(spark, f"{tmp_path}/a").collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["n_tokens"], bytes(r["tokens"])))
    start = 0
    for i, t, *_ in sorted(messy, key=lambda r: r[0]):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        assert (start, len(ids), ids.tobytes()) in got[i]
        start += len(ids)
    repair.write_token_files(nothing, WORDS, f"{tmp_path}/b")
    assert repair.read_token_files(spark, f"{tmp_path}/b").count() == 0


def test_grammars_expand_to_what_they_replaced():
    rng = np.random.default_rng(0)
    for _ in range(100):
        ids = rng.integers(0, rng.integers(2, 6), rng.integers(0, 500)).astype(np.uint32)
        seq, rules, first = repair.compress(ids)
        lengths = repair.expansion_lengths(rules, first)
        assert (repair.expand(seq, rules, first) == ids).all() and (repair.decoder(rules, first, lengths)(seq) == ids).all()
        assert all(len(repair.expand(np.array([first + k]), rules, first)) == n for k, n in enumerate(lengths))


def test_repeated_pairs_become_rules():
    ids = np.tile(np.array([5, 6, 7, 8, 9, 1], np.uint32), 100)
    seq, rules, first = repair.compress(ids)
    assert len(seq) < len(ids) / 2 and not (rules == 1).any()


def test_pairs_are_named_until_none_is_frequent():
    rng = np.random.default_rng(5)
    passage = rng.integers(2, 60_000, 512)
    noise = rng.integers(2, 60_000, 50_000)
    ids = np.concatenate([*(np.r_[passage, rng.integers(2, 60_000, 3), 1] for _ in range(40)), noise]).astype(np.uint32)
    seq, rules, first = repair.compress(ids)
    assert (repair.expand(seq, rules, first) == ids).all() and repair.expansion_lengths(rules, first).max() > 100
    for part in (seq, repair.compress(rng.integers(2, 40, 20_000).astype(np.uint32))[0]):
        pairs = Counter((a, b) for a, b in zip(part.tolist(), part[1:].tolist()) if 1 not in (a, b))
        assert max(pairs.values()) < repair.LEAST


def test_rounds_count_what_may_be_frequent_and_not_the_whole_sequence(monkeypatch):
    rng = np.random.default_rng(3)
    ids = (rng.zipf(1.2, 60_000) % 5_000 + 2).astype(np.uint32)
    whole, counted = repair.frequent_pairs, []

    def noted(keys):
        pairs, counts, number = whole(keys)
        plain = Counter(keys.tolist())
        assert dict(zip(pairs.tolist(), counts.tolist())) == {k: n for k, n in plain.items() if n >= repair.LEAST}
        assert all((pairs[i] == k if i >= 0 else plain[k] < repair.LEAST) for k, i in zip(keys, number))
        counted.append(len(keys))
        return pairs, counts, number

    monkeypatch.setattr(repair, "frequent_pairs", noted)
    seq, rules, first = repair.compress(ids)
    assert (repair.expand(seq, rules, first) == ids).all()
    pairs = Counter(zip(seq[:-1].tolist(), seq[1:].tolist()))
    assert len(counted) > 3 and max(pairs.values()) < repair.LEAST
    assert sum(counted[1:]) < len(ids) < (len(counted) - 1) * len(seq)


def test_columns_named_like_helper_columns_are_kept(spark):
    """Neither a row key nor the hits of earlier blocks may take the place of a column of the caller."""
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "x y z")], "doc_id long, text string")
    docs = docs.withColumn("_row", F.lit("mine")).withColumn("_HITS_so_far", F.lit("own"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "a b c d e f g", "mine", "own"), (3, "x y z", "mine", "own")]
    items = spark.createDataFrame([("i", "a b c"), ("j", "y z")], "item_id string, text string")
    hits = automaton.benchmark_hits(docs, items, window=2, block_bytes=4)
    assert hits.columns == [*docs.columns, "hits"]
    assert sorted((r["doc_id"], r["_row"], r["_HITS_so_far"], *r["hits"]["items"]) for r in hits.collect()) == [
        (1, "mine", "own", "i"), (2, "mine", "own", "i"), (3, "mine", "own", "j")]
