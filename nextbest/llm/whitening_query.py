"""Query op13: all embeddings whitened along their principal components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nextbest.llm.common import table
from nextbest.llm.whitening_qdwh import whitened


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES = {"op13_embedding_whitening": op13_embedding_whitening}
ORACLES = {}
