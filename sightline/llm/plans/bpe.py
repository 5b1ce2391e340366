"""Byte-level BPE over all documents, there and back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm.bpe import encode_and_decode
from sightline.llm.common import table
from sightline.llm.registry import query

RANKS = "byte_bpe_multi_50k.tiktoken"


@query("op4_bpe")
def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_and_decode(documents, *vocabulary).select("doc_id", "coded.*")
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
