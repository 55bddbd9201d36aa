"""Query op4: the mix of all documents, and the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nextbest.llm import entropy_mix as em
from nextbest.llm.common import table


def op4_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return em.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


#: Rounds of resharing that the SQL unrolls; each caps one source at least.
_SQL_CAPS = 12


def _oracle() -> str:
    """Targets by unrolled rounds; the tilt in its closed form target / size."""
    ctes = [r"""d0 AS MATERIALIZED (SELECT doc_id, source,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
  md5(coalesce(doc_id::varchar, '') || chr(10) || coalesce(text, '')) AS h FROM documents)""",
            """d AS MATERIALIZED (SELECT doc_id, source, size,
  CASE WHEN j > 1 THEN md5(h || chr(10) || j::varchar) ELSE h END AS h FROM (
  SELECT *, row_number() OVER (PARTITION BY source, h) AS j FROM d0))""",
            f"""s0 AS MATERIALIZED (SELECT source, sum(size)::bigint AS source_size,
  (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(em.WEIGHTS)} + 1 AS w
  FROM d GROUP BY source)""",
            "share0 AS MATERIALIZED (SELECT sum(source_size) / sum(w) AS share FROM s0)"]
    cap = em.MAX_COPIES
    for i in range(_SQL_CAPS):
        capped = f"w * share > {cap} * source_size"
        ctes.append(f"""share{i + 1} AS MATERIALIZED (SELECT coalesce(
  (sum(source_size) - coalesce(sum({cap} * source_size) FILTER ({capped}), 0))
  / nullif(sum(w) FILTER (NOT ({capped})), 0), any_value(share)) AS share FROM s0, share{i})""")
    ctes.append(f"""t AS MATERIALIZED (SELECT *, floor(rate + 1e-9)::int AS copies,
  greatest(rate * source_size - floor(rate + 1e-9) * source_size, 0) AS rest FROM (
  SELECT *, CASE WHEN target > 0 THEN target / source_size ELSE 0 END AS rate FROM (
  SELECT source, source_size, least(w * share, {cap} * source_size)::double AS target
  FROM s0, share{_SQL_CAPS})))""")
    ctes.append("""o AS MATERIALIZED (SELECT doc_id, d.source, size, h, rest, sum(size) OVER (
  PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)""")
    ctes.append(f"""g0 AS MATERIALIZED (SELECT source, any_value(rest) - coalesce(
  sum(size) FILTER (upto <= rest + {em.TOL}), 0) AS gap, NULL::struct(size bigint, h varchar)
  AS fill, []::varchar[] AS fills FROM o GROUP BY source)""")
    for i in range(em.FILL_ROUNDS):
        ctes.append(f"""f{i} AS MATERIALIZED (SELECT o.source, max({{'size': size, 'h': h}}) AS pick
  FROM o JOIN g{i} g ON o.source IS NOT DISTINCT FROM g.source
  WHERE upto > rest + {em.TOL} AND size > 0 AND size <= gap + {em.TOL}
  AND (fill IS NULL OR {{'size': size, 'h': h}} < fill) GROUP BY o.source),
g{i + 1} AS MATERIALIZED (SELECT g.source, gap - coalesce(pick.size, 0) AS gap,
  coalesce(pick, fill) AS fill,
  CASE WHEN pick IS NULL THEN fills ELSE list_append(fills, pick.h) END AS fills
  FROM g{i} g LEFT JOIN f{i} f ON f.source IS NOT DISTINCT FROM g.source)""")
    last = em.FILL_ROUNDS
    ctes.append(f"""o_left AS (SELECT o.source, o.size, o.h, g.gap, g.fills FROM o
  JOIN g{last} g ON o.source IS NOT DISTINCT FROM g.source WHERE upto > rest + {em.TOL})""")
    ctes.append(f"""over AS MATERIALIZED (SELECT source, min({{'size': size, 'h': h}}) AS pick
  FROM o_left WHERE size > gap + {em.TOL} AND size < 2 * gap - {em.TOL}
  AND NOT list_contains(fills, h) GROUP BY source)""")
    ctes.append(f"""g AS MATERIALIZED (SELECT g.source, CASE WHEN pick IS NULL THEN fills
  ELSE list_append(fills, pick.h) END AS fills
  FROM g{last} g LEFT JOIN over ON over.source IS NOT DISTINCT FROM g.source)""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, size, source_size, target, size * (copies + CASE WHEN upto <= t.rest + {em.TOL}
  OR list_contains(fills, h) THEN 1 ELSE 0 END) AS taken
FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source
JOIN g ON o.source IS NOT DISTINCT FROM g.source"""


QUERIES = {"op4_entropy_mix": op4_entropy_mix}
ORACLES = {"op4_entropy_mix": _oracle()}
