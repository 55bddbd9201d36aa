"""Query op11: spelling variants among the words of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nextbest.llm.common import table
from nextbest.llm.spelling_fm import variant_groups


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op11_spelling_variants": op11_spelling_variants}
ORACLES = {}
