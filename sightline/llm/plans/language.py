"""Language of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm.common import fold, table
from sightline.llm.language import TRAIN_DOCUMENTS, predict_languages, train
from sightline.llm.registry import query

MODULUS, HELD_OUT = 4, 2


@query("op6_language")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    known = documents.where(F.col("lang").isNotNull() & (fold("doc_id", MODULUS) != HELD_OUT))
    chosen = known.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCUMENTS)
    model = train(known.join(F.broadcast(chosen), "doc_id"))
    found = predict_languages(documents.select("doc_id", "text"), model)
    return found.select("doc_id", (fold("doc_id", MODULUS) == HELD_OUT).alias("held_out"), "language.lang_pred", "language.score")
