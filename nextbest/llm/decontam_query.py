"""Query op9: every (document, benchmark item) pair where the item is contained."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from nextbest.llm.common import table
from nextbest.llm.decontam import find_contained


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_contained(docs, table(spark, sf_dir, "benchmark"))


def _shingle_sql(name: str, key: str) -> str:
    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return rf"""{name}_w AS (SELECT row_number() OVER () AS rid, {key}, regexp_extract_all(
  {lowered}, '[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+') AS w FROM {name} WHERE text IS NOT NULL),
{name}_s AS (SELECT rid, {key}, list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM {name}_w WHERE len(w) > 0)"""


_SQL = f"""WITH {_shingle_sql('documents', 'doc_id')},
{_shingle_sql('benchmark', 'item_id')},
pairs AS (SELECT d.rid AS d_rid, b.rid AS b_rid, any_value(doc_id) AS doc_id,
    any_value(item_id) AS item_id, count(*)::int AS n_common
  FROM (SELECT rid, doc_id, unnest(s) AS x FROM documents_s) d
  JOIN (SELECT rid, item_id, unnest(s) AS x FROM benchmark_s) b USING (x) GROUP BY ALL)
SELECT doc_id, p.item_id, n_common, len(s)::int AS n_shingles, n_common / len(s) AS containment
FROM pairs p JOIN benchmark_s b ON b.rid = b_rid WHERE n_common / len(s) >= 0.8"""

QUERIES = {"op9_decontamination": op9_decontamination}
ORACLES = {"op9_decontamination": _SQL}
