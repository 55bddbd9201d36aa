"""Query op3: fingerprints and near-duplicate components of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nextbest.llm.common import table
from nextbest.llm.simhash_bktree import hex_fingerprint, near_duplicates


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select(
        "doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


QUERIES = {"op3_simhash_dedup": op3_simhash_dedup}
ORACLES = {}
