"""Join helpers: broadcast of a side whose bytes were measured, else a salted shuffle join.

A broadcast is only safe when the small side has a proven size.  One aggregate
over it measures its bytes; above the bound the join shuffles with salted keys,
so that one hot key (say an attribute value shared by a third of all customers)
is spread over ``salts`` tasks instead of landing in one.  Both ways compute the
same rows from the same inputs.

``split_join`` is for two large sides: only the keys that are hot, found by one
pre-aggregated count, leave the ordinary shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nextbest.session import ensure_checkpoint_dir

#: Bytes of a table that may be broadcast.
BROADCAST_BYTES = 64 << 20
DEFAULT_SALTS = 32
#: Rows of one key that a shuffle join may bring into one task.
HOT_ROWS = 2_000_000
_FIELD_BYTES = 16

_SALT = "__salt"


def row_bytes(df: DataFrame, cols: list[str] | None = None) -> Column:
    """Estimated bytes of a row: fixed per field, plus the length of text and nested values."""
    types = dict(df.dtypes)
    total = F.lit(0).cast("bigint")
    for c in cols or df.columns:
        total = total + F.lit(_FIELD_BYTES)
        if types[c] in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif types[c].startswith(("array", "map", "struct")):
            total = total + F.octet_length(F.to_json(F.struct(c)))
    return total


def measured_bytes(df: DataFrame) -> int:
    """Runs one job; call it on an aggregated table (a fitted model), never on raw input."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def salted_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                salts: int = DEFAULT_SALTS, salt_by: list[str | Column] | None = None) -> DataFrame:
    """Shuffle join that splits every key of ``big`` over ``salts`` tasks.

    ``big`` rows get a deterministic salt from a hash of ``salt_by`` (default:
    all of its columns), so a recomputed partition after an executor loss gets
    the same salts.  ``small`` is replicated once per salt.
    """
    cols = salt_by or [F.col(c) for c in big.columns]
    salted_big = big.withColumn(_SALT, F.pmod(F.xxhash64(*cols), F.lit(salts)))
    salted_small = small.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_big.join(salted_small, on + [_SALT], how).drop(_SALT)


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
               max_bytes: int = BROADCAST_BYTES, salts: int = DEFAULT_SALTS,
               salt_by: list[str | Column] | None = None,
               known_bytes: int | None = None) -> DataFrame:
    """Broadcast ``small`` if its measured bytes allow, else a salted shuffle join.

    ``known_bytes`` was measured earlier on this same table; without it the
    table is measured here.
    """
    size = known_bytes if known_bytes is not None else measured_bytes(small)
    if size <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    return salted_join(big, small, on, how, salts, salt_by)


def split_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
               hot_rows: int = HOT_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``inner`` or ``left`` join of two large sides, safe against hot keys of ``big``.

    Keys with more than ``hot_rows`` rows are counted first (one row per key and
    map task is shuffled); there are at most rows / ``hot_rows`` of them.  Their
    rows meet the matching rows of ``small`` without a shuffle if those rows'
    measured bytes allow, else salted; all others meet in a plain shuffle join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    hot = big.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows")).where(
        F.col("__rows") > hot_rows).drop("__rows")
    ensure_checkpoint_dir(big.sparkSession)
    hot = hot.checkpoint(eager=True)
    if hot.isEmpty():
        return big.join(small, on, how)
    size = measured_bytes(hot)

    def part(df: DataFrame, kind: str) -> DataFrame:
        if size <= max_bytes:
            return df.join(F.broadcast(hot), on, kind)
        return df.join(hot, on, kind)

    rest = part(big, "left_anti").join(part(small, "left_anti"), on, how)
    few = part(small, "left_semi").checkpoint(eager=True)
    return rest.unionByName(join_small(part(big, "left_semi"), few, on, how, max_bytes))
