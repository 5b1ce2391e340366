"""Collocations of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sightline.llm.common import table
from sightline.llm.phrases import collocations
from sightline.llm.registry import query


@query(
    "op11_collocations",
    r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents
),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
f1 AS (SELECT lang, w AS phrase, count(*) AS f FROM (SELECT lang, unnest(w) AS w FROM w) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
spot AS (SELECT lang, w, unnest(range(1, len(w))) AS i FROM w WHERE len(w) > 1),
f2 AS (SELECT lang, w[i] AS a, w[i + 1] AS b, count(*) AS f FROM spot GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c, count(*) AS f FROM spot WHERE i + 1 < len(w) GROUP BY ALL HAVING count(*) >= 10),
two AS (
  SELECT f2.lang, f2.a || ' ' || f2.b AS phrase, f2.f AS a, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.phrase = f2.a JOIN f1 y ON y.lang = f2.lang AND y.phrase = f2.b
  WHERE NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = f2.lang AND t.a = f2.a AND t.b = f2.b AND 100 * t.f >= 50 * f2.f)
    AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = f2.lang AND t.b = f2.a AND t.c = f2.b AND 100 * t.f >= 50 * f2.f)
),
three AS (
  SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c AS phrase, f3.f AS a,
    x.f AS l1, q.f AS r1, p.f AS l2, y.f AS r2,
    1000000::HUGEINT * f3.f * f3.f // (x.f::HUGEINT * q.f) AS s1, 1000000::HUGEINT * f3.f * f3.f // (p.f::HUGEINT * y.f) AS s2
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.phrase = f3.a JOIN f1 y ON y.lang = f3.lang AND y.phrase = f3.c
    JOIN f2 p ON p.lang = f3.lang AND p.a = f3.a AND p.b = f3.b JOIN f2 q ON q.lang = f3.lang AND q.a = f3.b AND q.b = f3.c
),
every AS (
  SELECT lang, phrase, a, l, r, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM two
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)::BIGINT FROM three
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM every)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
""",
)
def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))
