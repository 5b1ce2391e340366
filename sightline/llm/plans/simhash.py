"""SimHash near duplicates over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sightline.llm.common import table
from sightline.llm.registry import query
from sightline.llm.simhash import hex_digits, simhash_components


@query("op9_simhash")
def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_digits("fingerprint").alias("fingerprint"), "component_id")
