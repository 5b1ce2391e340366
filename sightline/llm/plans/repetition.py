"""Repetition rules over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sightline.llm.common import table
from sightline.llm.registry import query
from sightline.llm.repetition import LIMITS, LINE_LIMIT, repetition_rules

_FINE = "\n    AND ".join(f"coalesce(max(chars) FILTER (n = {n}), 0) <= {limit} * max(word_chars)" for n, limit in LIMITS.items())


@query(
    "op2_repetition",
    rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols
  FROM d
),
g AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (VALUES (3), {", ".join(f"({n})" for n in LIMITS)}) AS s(n) WHERE len(w) >= n)
),
dup AS (
  SELECT DISTINCT doc_id, n, unnest(range(i, i + n)) AS p
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, n, g) AS c FROM g) WHERE c > 1
),
cov AS (SELECT doc_id, n, count(*) AS words, sum(length(w[p])) AS chars FROM dup JOIN d USING (doc_id) GROUP BY doc_id, n),
lines AS (
  SELECT doc_id, line, count(*) - 1 AS more, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line
),
line AS (SELECT doc_id, sum(more) AS dups, sum(more * chars) AS chars FROM lines GROUP BY doc_id),
judged AS (
  SELECT base.doc_id, max(n_words) AS n_words, max(word_chars) AS word_chars, max(n_symbols) AS n_symbols,
    coalesce(max(line.dups), 0)::BIGINT AS n_dup_lines, coalesce(max(cov.words) FILTER (n = 3), 0)::BIGINT AS n_repeat_words,
    coalesce(max(line.chars), 0) <= {LINE_LIMIT} * max(word_chars)
    AND {_FINE.replace("max(chars)", "max(cov.chars)")} AS fine
  FROM base LEFT JOIN line USING (doc_id) LEFT JOIN cov USING (doc_id) GROUP BY base.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND fine AS kept
FROM judged
""",
)
def repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruled = repetition_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return ruled.select("doc_id", *(f"repetition.{n}" for n in names))
