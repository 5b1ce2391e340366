"""Repeated word windows over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm.common import table
from sightline.llm.countmin import remove_repeated_windows
from sightline.llm.registry import query


@query(
    "op13_substring_dedup",
    r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
),
f AS (SELECT g, min(doc_id) AS least FROM g GROUP BY g),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM g JOIN f USING (g) WHERE doc_id > least),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM word ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeated_windows(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
