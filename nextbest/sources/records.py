"""Text sources and sinks: delimited snapshot files, line records, ranked lists.

All parsing is done with built-in expressions on the output of Spark's own
readers, so it runs in the JVM inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Text that the snapshot files use for a missing value.
NA_TOKENS = ["-999999", "NA", "         NA"]
# Text that a pandas CSV scan takes for missing by default.
DEFAULT_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def null_tokens(df: DataFrame, cols: list[str] | None = None,
                tokens: list[str] = NA_TOKENS) -> DataFrame:
    """Turn NA tokens, the usual ones included, and empty text into nulls (after trimming)."""
    trimmed = sorted({t.strip() for t in [*tokens, *DEFAULT_NA_TOKENS]})
    targets = cols or [c for c, t in df.dtypes if t == "string"]

    def fix(c: str) -> Column:
        return F.when(F.trim(F.col(c)).isin(trimmed), F.lit(None)).otherwise(F.col(c)).alias(c)

    return df.select(*[fix(c) if c in targets else F.col(c) for c in df.columns])


BAD_RECORD = "_bad_record"


def read_snapshot_csv(spark: SparkSession, path: str, schema: StructType | None = None,
                      tokens: list[str] = NA_TOKENS, bad_records: str = "pad") -> DataFrame:
    """CSV with a header and quoted fields; every column read as text, NA tokens nulled.

    Reading as text and converting afterwards (``functions.scalars``) keeps bad
    values from failing the scan under ANSI mode.  Give ``schema`` to skip
    inference of column names on very large inputs.

    ``bad_records`` says what a line with too few or too many fields does:
    ``pad`` fills with nulls and cuts, ``keep`` does so and puts the line into
    the column ``_bad_record`` (null on good lines), ``raise`` fails the scan.
    """
    if bad_records not in ("pad", "keep", "raise"):
        raise ValueError(f"bad_records must be 'pad', 'keep' or 'raise', not {bad_records!r}")
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    if bad_records != "pad":
        # fields are only counted if all columns are parsed
        named = schema or reader.csv(path).schema
        reader = reader.option("columnPruning", False).option(
            "mode", "FAILFAST" if bad_records == "raise" else "PERMISSIVE")
        schema = StructType(list(named.fields))
        if bad_records == "keep":
            schema = schema.add(BAD_RECORD, "string")
            reader = reader.option("columnNameOfCorruptRecord", BAD_RECORD)
    df = reader.schema(schema).csv(path) if schema else reader.csv(path)
    return null_tokens(df, [c for c, t in df.dtypes if t == "string" and c != BAD_RECORD],
                       tokens=tokens)


def parse_lines(lines: DataFrame, names: list[str], header_marker: str | None = None,
                value: str = "value", sep: str = ",") -> DataFrame:
    """Split comma-separated text lines into trimmed text columns.

    Blank lines and lines containing ``header_marker`` (a header) are dropped.
    """
    text = F.col(value)
    keep = text.isNotNull() & (F.length(F.trim(text)) > 0)
    if header_marker:
        keep = keep & ~text.contains(header_marker)
    parts = F.split(text, sep, -1)
    return lines.where(keep).select(
        *[F.trim(F.get(parts, i)).alias(n) for i, n in enumerate(names)])


def read_lines(spark: SparkSession, path: str, names: list[str],
               header_marker: str | None = None) -> DataFrame:
    return parse_lines(spark.read.text(path), names, header_marker)


def parse_ranked_list(lines: DataFrame, value: str = "value", id_col: str = "customer",
                      items: str = "items") -> DataFrame:
    """``id,item item ...`` lines -> ``(id bigint, items array<string>)``.

    Carriage returns at line end are removed; blank lines are skipped.
    """
    text = F.regexp_replace(F.col(value), "\r$", "")
    parts = F.split(text, ",", 2)
    rest = F.trim(F.get(parts, 1))
    return (lines.where(F.length(F.trim(text)) > 0)
            .select(F.trim(F.get(parts, 0)).cast("bigint").alias(id_col),
                    F.when(F.coalesce(rest, F.lit("")) == "", F.array().cast("array<string>"))
                    .otherwise(F.split(rest, " ")).alias(items)))


def read_ranked_list(spark: SparkSession, path: str, id_col: str = "customer",
                     items: str = "items") -> DataFrame:
    return parse_ranked_list(spark.read.text(path), id_col=id_col, items=items)


def format_ranked_list(records: DataFrame, id_col: str = "customer", items: str = "items",
                       out: str = "value", keep_id: bool = False) -> DataFrame:
    """``(id, items)`` -> one text column ``id,item item ...`` (plus the id if asked)."""
    line = F.concat_ws(",", F.col(id_col).cast("string"), F.concat_ws(" ", items)).alias(out)
    return records.select(id_col, line) if keep_id else records.select(line)


def write_ranked_list(records: DataFrame, path: str, id_col: str = "customer",
                      items: str = "items", single_file: bool = False,
                      mode: str = "overwrite") -> None:
    """Write sorted ranked-list text.  ``single_file`` is for small outputs only;
    ``mode="error"`` refuses a folder that exists."""
    ordered = records.orderBy(F.col(id_col).cast("bigint"))
    if single_file:
        ordered = ordered.coalesce(1)
    format_ranked_list(ordered, id_col, items).write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Table sink; CSV gets a header line.  ``mode="error"`` refuses a folder that exists."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
