"""Fill-in-the-middle examples of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm.common import table
from sightline.llm.infill import fill_in_middle
from sightline.llm.registry import query


def _draw(k: int) -> str:
    return f"('0x' || substr(h, {8 * k + 1}, 8))::BIGINT"


@query(
    "op12_infill",
    rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
),
c AS (
  SELECT doc_id, t, u, len(u) AS n,
    least({_draw(0)} % (len(u) + 1), {_draw(1)} % (len(u) + 1)) AS a,
    greatest({_draw(0)} % (len(u) + 1), {_draw(1)} % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {_draw(2)} % 100 >= 50 THEN 'plain'
         WHEN {_draw(3)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d
),
p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
""",
)
def infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    digest = {f"{c}_sha256": F.sha2(F.col(f"infill.{c}").cast("binary"), 256) for c in ("output", "restored")}
    return cut.select("doc_id", *(f"infill.{c}" for c in ("n", "form", "prefix_chars", "middle_chars")), *(v.alias(k) for k, v in digest.items()))
