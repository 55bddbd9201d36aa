"""Small helpers that the operators of this package share."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nextbest.session import ensure_checkpoint_dir

#: Words: runs of anything but ASCII white space (space, tab, LF, VT, FF, CR).
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def hash_sample(rows: DataFrame, col: str, limit: int) -> DataFrame:
    """At most ``limit`` rows, those with the smallest hashes of ``col``.

    Rows far above the hash that the limit will end at are left out first, so
    that not every task sends ``limit`` rows to the merge.
    """
    total, rank = rows.count(), F.shiftrightunsigned(F.xxhash64(col), 1)
    if total > limit:
        share = min(1.0, (1.1 * limit + 1000) / total)
        rows = rows.where(rank <= F.lit(int(share * ((1 << 63) - 1))))
    return rows.orderBy(rank, col).limit(limit)


def words(text: Column) -> Column:
    """The words of a text as an array (null text: empty array)."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.filter(parts, lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_UPPER_TO_LOWER = {c: c + 32 for c in range(65, 91)}


def py_lower_ascii(text: str) -> str:
    return text.translate(_UPPER_TO_LOWER) if not text.isascii() else text.lower()


def crc(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], name: str = "text",
           max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that column ``name`` holds about ``max_bytes`` at most.

    A single row above the bound still comes whole, in a batch of its own.
    """
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(name))
        size = max(1, col.nbytes)
        step = max(1, min(batch.num_rows, batch.num_rows * max_bytes // size))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
