"""Scalar Column expressions used by the cleaning operators.

All are built-in expressions (JVM side, whole-stage codegen); none is a
Python UDF.  ANSI mode is on in Spark 4, so conversions of untrusted text use
the ``try_`` forms, which give null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the snapshot format.
DATE_FORMAT = "yyyy-MM-dd"
BASE_DATE = "1902-01-01"
DEFAULT_LAST_PRIMARY_DATE = "2015-01-28"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Decimal numbers; Spark's own cast would also take ``12d``, ``7f`` and ``0x1p3``.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def numeric_coerce(c: str | Column, to: str = "double") -> Column:
    """Text -> number; blanks, bad text and NaN -> null (``errors='coerce'``)."""
    text = F.trim(_c(c).cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast(to))


def flag(c: str | Column) -> Column:
    """1 for a numeric 1 in any spelling (``1``, ``1.0``, ``' 1'``), 0 for other numbers."""
    return (numeric_coerce(c) == 1).cast("int")


def id_text(c: str | Column) -> Column:
    """An id as text: whole numbers in plain form (``007`` -> ``7``), other text as it is."""
    text = _c(c).cast("string")
    return F.coalesce(F.trim(text).try_cast("bigint").cast("string"), text)


#: What a missing attribute value becomes, so that missing matches missing.
BLANK = ""


def attr_text(c: str, dtype: str) -> Column:
    """An attribute value as text; whole numbers alike in every numeric type, null -> blank."""
    col = F.col(c)
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        text = col.cast("bigint").cast("string")
    elif dtype in ("float", "double") or dtype.startswith("decimal"):
        number = col.cast("double")
        whole = (number == F.floor(number)) & (F.abs(number) < F.lit(9.0e15))
        text = F.when(F.isnan(number), F.lit(None)).when(
            whole, number.try_cast("bigint").cast("string")).otherwise(col.cast("string"))
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit(BLANK))


def parse_date(c: str | Column, fmt: str = DATE_FORMAT) -> Column:
    """Text -> date with a fixed format; bad text -> null."""
    return F.try_to_timestamp(F.trim(_c(c).cast("string")), F.lit(fmt)).cast("date")


def default_date(c: str | Column, default: str = DEFAULT_LAST_PRIMARY_DATE) -> Column:
    """Null date -> a fixed date."""
    return F.coalesce(_c(c), F.lit(default).cast("date"))


def days_since(c: str | Column, base: str = BASE_DATE) -> Column:
    """Whole days from ``base`` to the date (negative before it)."""
    return F.datediff(_c(c), F.lit(base).cast("date"))


def clamp_min(c: str | Column, lo) -> Column:
    """Values below ``lo`` become ``lo``; nulls stay null."""
    col = _c(c)
    return F.when(col < F.lit(lo), F.lit(lo)).otherwise(col)


def truncate_int(c: str | Column, to: str = "int") -> Column:
    """Truncate toward zero (``23.9 -> 23``, ``-1.5 -> -1``)."""
    return _c(c).cast(to)


def code_map(c: str | Column, mapping: dict) -> Column:
    """Map listed values to their codes and pass every other value through."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(str(k)), F.lit(str(v))]
    col = _c(c).cast("string")
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), col)


def replace_values(c: str | Column, mapping: dict) -> Column:
    """Exact replacement of listed literals (one bad spelling -> canonical)."""
    col = _c(c)
    out = col
    for bad, good in mapping.items():
        out = F.when(col == F.lit(bad), F.lit(good)).otherwise(out)
    return out
