"""Quality of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm.common import fold, labelled_ids, table
from sightline.llm.mil import TRAIN_DOCUMENTS, quality_scores, train
from sightline.llm.registry import query

MODULUS, HELD_OUT, THRESHOLD = 5, 0, 0.3


def quality_model(spark: SparkSession, sf_dir: str, documents: DataFrame | None = None):
    documents = table(spark, sf_dir, "documents") if documents is None else documents
    labels = labelled_ids(table(spark, sf_dir, "labels"), "quality", MODULUS, HELD_OUT, TRAIN_DOCUMENTS)
    return train(documents, labels)


@query("op7_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_scores(documents, quality_model(spark, sf_dir, documents))
    return scored.select("doc_id", (fold("doc_id", MODULUS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
