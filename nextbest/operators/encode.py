"""Category dictionaries: fit once, encode training and scoring data alike.

Codes run 1..n per column in order of first appearance, where "first" is the
smallest ``order_cols`` tuple of a row holding the value (value text breaks
ties), so the codes do not depend on file or partition order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nextbest.operators.joins import BROADCAST_BYTES, join_small, row_bytes
from nextbest.operators.ranking import positions
from nextbest.session import ensure_checkpoint_dir


def category_dictionary(df: DataFrame, cols: list[str], order_cols: list[str]) -> DataFrame:
    """``(column, value, code)`` for the non-null values of ``cols``.

    The first-appearance aggregate is partial before its shuffle; numbering
    uses range-partitioned positions, so a column with many values is not
    numbered in one task.
    """
    text = df.select(*order_cols, *[F.col(c).cast("string").alias(c) for c in cols])
    long = text.unpivot(order_cols, cols, "column", "value").where(F.col("value").isNotNull())
    firsts = long.groupBy("column", "value").agg(
        F.min(F.struct(*order_cols)).alias("first"))
    coded = positions(firsts, ["first", "value"], ["column"], pos="code")
    return coded.select("column", "value", F.col("code").cast("int").alias("code"))


#: Values of a column that the nested lookup may hold; a larger one is joined on its own.
NESTED_VALUES = 4096


def encode_categories(df: DataFrame, dictionary: DataFrame, cols: list[str],
                      unseen_code: int | None = None,
                      max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Replace each of ``cols`` by its code; values missing from the dictionary
    get ``unseen_code`` (default null).

    Columns of up to ``NESTED_VALUES`` values share one lookup row (see
    ``_lookups``): the facts are read once, without a join.  A larger column is
    joined on its own, broadcast if its measured bytes allow, else by shuffle
    with salted keys, since one value may cover most rows.  The nested row and
    the broadcast columns stay within ``max_bytes`` together, smallest first.
    """
    ensure_checkpoint_dir(df.sparkSession)
    known = dictionary.where(F.col("column").isin(list(cols))).select(
        "column", "value", "code").checkpoint(eager=True)
    sizes = {r["column"]: (r["n"], r["bytes"]) for r in known.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_bytes(known, ["value", "code"])).alias("bytes"))
        .collect()}
    nested, joined, left = {}, {}, max_bytes
    for c in sorted(cols, key=lambda c: sizes.get(c, (0, 0))[1]):
        n, size = sizes.get(c, (0, 0))
        fits = size <= left and max_bytes > 0
        left -= size if fits else 0
        if fits and n <= NESTED_VALUES:
            nested[c] = n
        else:
            joined[c] = size if fits else max_bytes + 1
    text = {c: F.col(c).cast("string") for c in cols}

    def filled(c: str, code: Column) -> Column:
        if unseen_code is None:
            return code.cast("int")
        return F.when(F.col(c).isNotNull(), F.coalesce(code, F.lit(unseen_code))).cast("int")

    codes = _lookups(known, nested, text)
    out = df.withColumns({c: filled(c, code) for c, code in codes.items()}) if codes else df
    for c, size in joined.items():
        d = known.where(F.col("column") == c).select(
            F.col("value").alias("__v"), F.col("code").alias("__code"))
        met = join_small(out.withColumn("__v", text[c]), d, ["__v"], "left", max_bytes,
                         known_bytes=size)
        out = met.withColumn(c, filled(c, F.col("__code"))).drop("__v", "__code")
    return out.select(*df.columns)


def _lookups(known: DataFrame, sizes: dict[str, int], text: dict[str, Column]) -> dict[str, Column]:
    """A code column for each nested column, from one row.

    The row holds an array of small maps per column; a value's hash names its
    map, so a lookup compares with one or two values however many there are.
    """
    if not sizes:
        return {}
    slots = {c: max(1, n // 2) for c, n in sizes.items()}
    n_slots = F.lit(1)
    for c, n in slots.items():
        n_slots = F.when(F.col("column") == c, n).otherwise(n_slots)
    maps = known.where(F.col("column").isin(list(sizes))).groupBy(
        "column", F.pmod(F.xxhash64("value"), n_slots).cast("int").alias("slot")).agg(
        F.map_from_entries(F.collect_list(F.struct("value", "code"))).alias("codes"))
    by_slot = maps.groupBy("column").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "codes"))).alias("slots"))
    row = by_slot.groupBy().agg(*[F.first(F.when(F.col("column") == c, F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.element_at("slots", i))), True).alias(f"s{k}")
        for k, (c, n) in enumerate(slots.items())])
    lookup = row.select(F.struct(*row.columns)).scalar()
    return {c: F.element_at(F.get(lookup[f"s{k}"], F.pmod(F.xxhash64(text[c]), F.lit(n)).cast("int")),
                            text[c]) for k, (c, n) in enumerate(slots.items())}
