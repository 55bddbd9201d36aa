"""Query op7: token files of all documents, written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from nextbest.llm.common import table
from nextbest.llm.token_huffman import read_documents, write_tokens
from nextbest.session import ensure_checkpoint_dir

END_ID = 1


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def token_files(docs: DataFrame) -> DataFrame:
    """Write ``docs`` to a new folder beside the checkpoints and read every document back."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, folder, default_tokenizer(), END_ID)
    return read_documents(spark, folder)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op7_token_files": op7_token_files}
ORACLES = {}
