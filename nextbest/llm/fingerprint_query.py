"""Query op12: fingerprints of all documents, of their edited texts, and their likeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nextbest.llm.common import table
from nextbest.llm.prefix_hash import edited_and_next


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_and_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op12_document_fingerprints": op12_document_fingerprints}
ORACLES = {}
