"""Toxicity of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm.common import fold, labelled_ids, table
from sightline.llm.neighbours import TRAIN_DOCUMENTS, toxicity, train
from sightline.llm.registry import query

MODULUS, HELD_OUT, THRESHOLD = 3, 1, 0.7


@query("op1_toxicity")
def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = labelled_ids(table(spark, sf_dir, "labels"), "toxic", MODULUS, HELD_OUT, TRAIN_DOCUMENTS)
    judged = toxicity(documents, train(documents, labels))
    return judged.select(
        "doc_id",
        (fold("doc_id", MODULUS) == HELD_OUT).alias("held_out"),
        "toxicity.score",
        (F.col("toxicity.score") >= THRESHOLD).cast("int").alias("predicted"),
        "toxicity.evidence",
    )
