"""Corpus pipeline: the stages that turn ``documents`` into token files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from nextbest.llm import decontam, entropy_mix, simhash_bktree, weak_rules
from nextbest.llm.common import table
from nextbest.llm.token_query import token_files
from nextbest.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised quality verdict keeps."""
    return weak_rules.keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return simhash_bktree.keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    return entropy_mix.apply_mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and from them one row per document: doc_id, start, n_tokens, ids_crc32."""
    return token_files(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash dedup", simhash_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mix", mix_sources),
    ("token output", token_output),
]

#: SQL can express neither XXH64 fingerprints nor the tokenizer; the tests hold
#: the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result but the last is written and reread."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for n, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return STAGES[-1][1](spark, docs, sf_dir)
