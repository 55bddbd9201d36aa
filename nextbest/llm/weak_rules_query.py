"""Query op8: quality verdicts for all documents, and the same in DuckDB SQL."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

from nextbest.llm.common import table
from nextbest.llm import weak_rules as wr

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "base_failed", "kept"]


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return wr.weak_quality(docs, keep=["doc_id"]).select(*COLUMNS)


_STATS_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
      FROM d),
win AS (SELECT rid, i, [w[i], w[i + 1], w[i + 2]] AS k
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
hit AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win)
        WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + o) AS n_repeat_words
        FROM hit, (SELECT unnest([0, 1, 2]) AS o) GROUP BY rid),
stats AS MATERIALIZED (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS n_repeat_next,
    length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_upper,
    length(regexp_replace(t, '[^!?]+', '', 'g')) AS n_marks
  FROM w LEFT JOIN rep USING (rid))"""


def _oracle() -> str:
    """The EM steps unrolled, one pair of subqueries for each."""
    rules = wr.DEFAULT_RULES
    names = [r.name for r in rules]
    votes = ", ".join(f"{r.sql()} AS vote_{r.name}" for r in rules)
    keys = ", ".join(f"vote_{n}" for n in names)
    ctes = [_STATS_SQL, f"voted AS MATERIALIZED (SELECT *, {votes} FROM stats)",
            f"pat AS MATERIALIZED (SELECT {keys}, count(*) AS n FROM voted GROUP BY ALL)"]
    start = ", ".join([f"{math.log(wr.START_PRIOR / (1 - wr.START_PRIOR))!r}::double AS prior"]
                      + [f"{math.log(wr.START_ACCURACY / (1 - wr.START_ACCURACY))!r}::double"
                         f" AS a_{n}" for n in names])
    ctes.append(f"m0 AS MATERIALIZED (SELECT {start})")
    odds = "prior + " + " + ".join(f"a_{n} * vote_{n}" for n in names)
    for i in range(wr.ITERATIONS):
        ctes.append(f"e{i} AS MATERIALIZED (SELECT pat.*, 1 / (1 + exp(-({odds}))) AS good"
                    f" FROM pat, m{i})")
        share = (f"(coalesce(sum(good * n), 0) + {wr.PSEUDO * wr.START_PRIOR})"
                 f" / (coalesce(sum(n), 0) + {wr.PSEUDO})")
        cols = [f"ln({share} / (1 - {share})) AS prior"]
        for n in names:
            acc = (f"(coalesce(sum(CASE vote_{n} WHEN 1 THEN good * n WHEN -1 THEN (1 - good) * n"
                   f" END), 0) + {wr.PSEUDO * wr.START_ACCURACY})"
                   f" / (coalesce(sum(CASE WHEN vote_{n} <> 0 THEN n END), 0) + {wr.PSEUDO})")
            cols.append(f"ln({acc} / (1 - {acc})) AS a_{n}")
        ctes.append(f"m{i + 1} AS MATERIALIZED (SELECT {', '.join(cols)} FROM e{i})")
    failed = (f"(n_words < {wr.MIN_WORDS} OR 100 * n_repeat_words > {wr.MAX_REPEAT_PCT} * n_words)")
    return (",\n".join(ctes) + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  {failed} AS base_failed, NOT {failed} AND 1 / (1 + exp(-({odds}))) >= 0.5 AS kept
FROM voted, m{wr.ITERATIONS}""")


QUERIES = {"op8_quality_rules": op8_quality_rules}
ORACLES = {"op8_quality_rules": _oracle()}
