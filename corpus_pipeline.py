"""From raw documents to encoded training text: every stage is one operator of ``sightline.llm``.

A stage takes what its predecessor kept, as rows of ``documents`` (doc_id, text, lang, source, n_chars), and
all but the last return such rows. Nulls count as empty texts, an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm.automaton import benchmark_hits, remove_hits
from sightline.llm.bpe import encode_and_decode
from sightline.llm.common import ready, table
from sightline.llm.mil import quality_scores
from sightline.llm.plans.bpe import RANKS
from sightline.llm.plans.mil import THRESHOLD, quality_model
from sightline.llm.simhash import keep_one
from sightline.llm.suffix import remove_repeats
from sightline.session import scratch_path

SHINGLE_WORDS, SIMILARITY = 5, 0.8  # near copies by their shingles
PRINT_WORDS, PRINT_BITS = 3, 3  # near copies by their fingerprints
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents``; the length follows the text."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects."""
    ready(spark)
    scored = quality_scores(docs, quality_model(spark, sf_dir, docs), output="_score")
    return scored.where(F.col("_score") >= THRESHOLD).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of least id of each group of near copies, linked by SimHash or by the share of five-word shingles in common."""
    ready(spark)
    kept = keep_one(docs, bits=PRINT_BITS, words=SHINGLE_WORDS, similarity=SIMILARITY, fingerprint_words=PRINT_WORDS)
    return kept.select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out what repeats an earlier document, by whole characters; a row without id matches nothing and passes by."""
    ready(spark)
    cut = remove_repeats(docs.where("doc_id IS NOT NULL"), whole_characters=True, carried=("lang", "source"))
    cut = cut.select("doc_id", F.col("kept").cast("string").alias("text"), "lang", "source")
    bare = docs.where("doc_id IS NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang", "source")
    return _documents(cut.union(bare))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out benchmark passages; a document that is mostly such goes."""
    hits = benchmark_hits(docs, table(spark, sf_dir, "benchmark"), output="_hits", rest=True)
    return _documents(remove_hits(hits, "_hits"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it."""
    ready(spark)
    vocabulary = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    coded = encode_and_decode(docs.select("doc_id", "text"), *vocabulary).select("doc_id", "text", "coded.*")
    same = F.col("decoded") == F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return coded.select("doc_id", "token_ids", F.size("token_ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontamination", decontaminate),
    ("bpe", encode),
]

ORACLE_SQL = None  # the classifier cannot be expressed in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
