"""Query op10: turns recovered from marked and unmarked transcripts, and rendered.

The transcripts are those of ``conversations``.  Three of four, by the
conversation's hash, are whole texts in which the roles are written as the
markers of three common styles (a text holds up to ``PART`` messages, a longer
transcript is several); the model has to find the messages in them.  In the
fourth no role is written and each message is a row; there the model has only
line features and the order to go by.  Messages without a conversation or a turn
can't be put in order and stay rows of their own.  Roles of the held-out fold (crc32 of conv_id mod 5 = 0) are never learned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nextbest.llm.chat_hmm import format_chats
from nextbest.llm.common import fold, table
from nextbest.operators.ranking import positions

FOLDS, HELD_OUT = 5, 0
#: Messages of a text, so that no text is longer than a row may be.
PART = 256


def transcripts(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role (the state of each line) and text: whole marked transcripts and
    unmarked messages."""
    style = F.pmod(F.xxhash64(F.col("conv_id").cast("string")), F.lit(4))
    role = F.col("role")
    human = F.when(role == "user", "Human").when(role == "assistant", "AI").otherwise("System")
    sharp = F.when(role == "user", "### Instruction:\n").when(
        role == "assistant", "### Response:\n").otherwise("### Context:\n")
    marker = F.when(style == 0, F.concat(F.initcap(role), F.lit(": "))).when(
        style == 1, F.concat(human, F.lit(": "))).when(style == 2, sharp).otherwise("")
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    marked = conversations.select("conv_id", "turn", "role", (known & (style < 3)).alias("whole"),
                                  F.concat(F.coalesce(marker, F.lit("")), F.coalesce(
                                      "text", F.lit(""))).alias("text"))
    more = F.size(F.split("text", "\n")) - 1
    marked = marked.withColumn("role", F.concat(F.array("role"), F.array_repeat(
        F.concat("role", F.lit("+")), more)))
    # repeated rows are one message
    placed = positions(marked.where("whole").distinct(), ["turn", "text", "role"], ["conv_id"])
    parts = placed.groupBy("conv_id", F.floor((F.col("pos") - 1) / PART)).agg(
        F.min("turn").alias("turn"), F.array_sort(F.collect_list(
            F.struct("pos", "role", "text"))).alias("some"))
    parts = parts.select("conv_id", "turn", F.flatten(F.col("some.role")).alias("role"),
                         F.array_join(F.col("some.text"), "\n").alias("text"))
    return parts.unionByName(marked.where("not whole").drop("whole"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transcripts(table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", "text"))
    done = format_chats(rows, train=fold(F.col("conv"), FOLDS) != HELD_OUT)
    return done.withColumn("held_out", fold(F.col("conv_id"), FOLDS) == HELD_OUT)


QUERIES = {"op10_chat_format": op10_chat_format}
ORACLES = {}
