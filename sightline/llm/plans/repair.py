"""Token ids of all documents, written to files and read back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm.common import table
from sightline.llm.registry import query
from sightline.llm.repair import read_token_files, write_token_files
from sightline.session import scratch_path

VOCABULARY = "word_bpe_49k.json"


@query("op10_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), folder)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))
