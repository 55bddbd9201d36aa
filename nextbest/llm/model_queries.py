"""Queries op1 (quality), op2 (toxicity), op5 (language) and op6 (page text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nextbest.llm.common import table
from nextbest.llm.html_ttr import extract
from nextbest.llm.langid_rank import language_id
from nextbest.llm.quality_gam import score_quality
from nextbest.llm.toxicity_cnn import score_toxicity


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, table(spark, sf_dir, "labels"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return score_toxicity(docs, table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op1_quality_classifier": op1_quality_classifier, "op2_toxicity": op2_toxicity,
           "op5_language_id": op5_language_id, "op6_html_extraction": op6_html_extraction}
ORACLES = {}
