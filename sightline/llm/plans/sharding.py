"""All documents in even shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm.common import table
from sightline.llm.registry import query
from sightline.llm.sharding import balanced_shards

SHARDS = 24


@query("op8_sharding")
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = balanced_shards(table(spark, sf_dir, "documents"), SHARDS)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
