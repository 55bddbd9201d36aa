"""Wide snapshot rows -> long attribute and purchase facts (the reference's row generators)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextbest.functions import scalars as X


def attr_long(df: DataFrame, keys: list[str], attr_cols: list[str],
              attr: str = "attr", value: str = "value") -> DataFrame:
    """One row per (key, attribute): ``(keys..., attr, value)`` with text values.

    Whole numbers give the same text in every numeric type (``55`` and ``55.0``
    are one value) and a missing value is the blank text, so that missing matches
    missing.  Built on ``unpivot`` (an Expand node), so it stays inside one
    whole-stage-codegen span with no shuffle.
    """
    types = dict(df.dtypes)
    text = df.select(*keys, *[X.attr_text(c, types[c]).alias(c) for c in attr_cols])
    return text.unpivot(keys, attr_cols, attr, value)


def purchase_long(df: DataFrame, keys: list[str], product_cols: list[str],
                  product: str = "product", owned: str = "owned") -> DataFrame:
    """Product flag columns -> one ``(keys..., product)`` row per flag that is numeric 1."""
    flags = df.select(*keys, *[X.flag(c).alias(c) for c in product_cols])
    return (flags.unpivot(keys, product_cols, product, owned)
            .where(F.col(owned) == 1)
            .drop(owned))


def purchase_history(basket: DataFrame, customer: str = "customer",
                     product: str = "product") -> DataFrame:
    """Distinct ``(customer, product)`` pairs owned at any time in ``basket``."""
    return basket.select(customer, product).distinct()


def purchase_lists(history: DataFrame, customer: str = "customer",
                   product: str = "product", items: str = "items") -> DataFrame:
    """``(customer, items)`` with the sorted owned products.

    A list holds at most one entry per catalogue product, so the group size is
    bounded by the catalogue, not by the data.
    """
    return (history.groupBy(customer)
            .agg(F.array_sort(F.collect_set(product)).alias(items)))
