"""Cleaning operators for customer snapshots.

Statistics (means, minimum, medians) are computed by distributed aggregates;
only their one-row results reach the driver, where they become literals of
the fill expressions (the fit / transform split of a Spark ML imputer).
``clean_snapshot`` gathers all of them in two passes and fills in a third.

An interpolated median that fills an integer column is truncated to that type:
code columns stay codes, so a median of 0.5 fills 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from nextbest.functions import scalars as X
from nextbest.operators.joins import join_small
from nextbest.session import ensure_checkpoint_dir
from nextbest.operators.ranking import (as_number, exact_median, group_key, halfway,
                                       lower_median, middle)

UNKNOWN = "UNKNOWN"


# --------------------------------------------------------------------------- columns

def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def select_by_regex(df: DataFrame, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """Columns whose whole name matches ``pattern`` (plus ``keep`` columns first)."""
    matched = df.select(df.colRegex(f"`{pattern}`")).columns
    return df.select(*(keep or []), *[c for c in matched if c not in (keep or [])])


def conditional_update(df: DataFrame, col: str, predicate: Column, value) -> DataFrame:
    """``df.loc[predicate, col] = value``."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(col, F.when(predicate, v).otherwise(F.col(col)))


def constant_fill(df: DataFrame, fills: dict) -> DataFrame:
    """Null -> constant, per column; the constant is cast to the column type."""
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c]))
                           for c, v in fills.items()})


def unknown_fill(df: DataFrame, cols: list[str] | None = None, token: str = UNKNOWN) -> DataFrame:
    """Every text column (or ``cols``) gets ``token`` for null, all-null columns included."""
    targets = cols or [c for c, t in df.dtypes if t == "string"]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(token)) for c in targets})


def canonicalize_value(df: DataFrame, col: str, mapping: dict) -> DataFrame:
    return df.withColumn(col, X.replace_values(col, mapping))


def code_map(df: DataFrame, col: str, mapping: dict, null_as: str | None = None) -> DataFrame:
    c = F.coalesce(F.col(col).cast("string"), F.lit(null_as)) if null_as else F.col(col)
    return df.withColumn(col, X.code_map(c, mapping))


def _number(df: DataFrame, c: str, to: str = "int") -> Column:
    """A column as a number: typed ones as they are, text coerced and truncated to ``to``."""
    return X.truncate_int(X.numeric_coerce(c), to) if dict(df.dtypes)[c] == "string" else F.col(c)


def cast_flags(df: DataFrame, cols: list[str], to: str = "int") -> DataFrame:
    """Flags as integers; text such as ``1.0`` is read as a number, blanks become null."""
    return df.withColumns({c: _number(df, c).cast(to) for c in cols})


def drop_null_records(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=cols)


def sort_snapshot(df: DataFrame, cols: list[str]) -> DataFrame:
    """Range-partitioned sort, nulls last (pandas ``sort_values``)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row, one boolean per column: does it hold a null?  One pass."""
    targets = cols or df.columns
    return df.agg(*[F.coalesce(F.max(F.col(c).isNull()), F.lit(False)).alias(c)
                    for c in targets])


# --------------------------------------------------------------------------- numeric fills

def age_normalize(df: DataFrame, col: str, lo: float = 18, mid: float = 30,
                  hi: float = 100) -> DataFrame:
    """Coerce to number, then in this order:

    1. values below ``lo``  -> mean of values in ``[lo, mid]``
    2. values above ``hi``  -> mean of the (updated) values in ``[mid, hi]``
    3. nulls                -> mean of the (updated) column
    4. truncate to int

    All three means follow from one aggregation pass over the original values.
    """
    a = X.numeric_coerce(col)
    s = df.select(a.alias("a")).agg(*_age_sums("a", lo, mid, hi)).first()
    return df.withColumn(col, _age_fill(a, s, lo, mid, hi))


def _age_sums(c: str, lo: float, mid: float, hi: float) -> list[Column]:
    a = F.col(c)
    return [
        F.count(F.when(a < lo, 1)).alias("n_lt"),
        F.sum(F.when(a.between(lo, mid), a)).alias("s1"),
        F.count(F.when(a.between(lo, mid), 1)).alias("n1"),
        F.sum(F.when(a.between(mid, hi), a)).alias("s2"),
        F.count(F.when(a.between(mid, hi), 1)).alias("n2"),
        F.sum(F.when(a.between(lo, hi), a)).alias("s3"),
        F.count(F.when(a.between(lo, hi), 1)).alias("n3"),
        F.count(F.when(a > hi, 1)).alias("n_gt"),
    ]


def _age_fill(a: Column, s, lo: float, mid: float, hi: float) -> Column:
    """The filled age from the sums of the original values (row ``s``)."""
    m1 = s.s1 / s.n1 if s.n1 else None
    add = s.n_lt if (m1 is not None and m1 >= mid) else 0
    m2 = ((s.s2 or 0.0) + add * (m1 or 0.0)) / (s.n2 + add) if (s.n2 + add) else None
    num = (s.s3 or 0.0) + (s.n_lt * m1 if m1 is not None else 0.0) + \
        (s.n_gt * m2 if m2 is not None else 0.0)
    den = s.n3 + (s.n_lt if m1 is not None else 0) + (s.n_gt if m2 is not None else 0)
    m3 = num / den if den else None

    def lit(v):
        return F.lit(v).cast("double")

    step = (F.when(a < lo, lit(m1)).when(a > hi, lit(m2)).otherwise(a))
    return X.truncate_int(F.coalesce(step, lit(m3)))


def seniority_fill(df: DataFrame, col: str, floor: float = 0) -> DataFrame:
    """Coerce; null -> column minimum (taken before clamping); below ``floor`` -> ``floor``."""
    v = X.numeric_coerce(col)
    mn = df.select(F.min(v).alias("m")).first().m
    filled = F.coalesce(v, F.lit(mn).cast("double"))
    return df.withColumn(col, X.truncate_int(X.clamp_min(filled, float(floor))))


def median_fill(df: DataFrame, col: str) -> DataFrame:
    """Null -> exact (interpolated) median of the column."""
    med = exact_median(df, col).first()
    value = med["median"] if med else None
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value).cast(dict(df.dtypes)[col])))


def group_median_fill(df: DataFrame, col: str, group: str) -> DataFrame:
    """Null -> median of its group, else -> median of the whole column."""
    dtype = dict(df.dtypes)[col]
    kind = dict(df.dtypes)[group]
    of = F.explode(F.array(
        F.struct(F.lit(False).alias("whole"), F.col(group).alias("g")),
        F.struct(F.lit(True).alias("whole"), F.lit(None).cast(kind).alias("g")))).alias("of")
    long = df.select(of, as_number(col, dtype).alias("__key")).select("of.*", "__key")
    ensure_checkpoint_dir(df.sparkSession)
    found = middle(long, ["whole", "g"], "__key").where(F.col("n") > 0).select(
        "whole", group_key(["g"]).alias("__gk"),
        halfway("low", "high", dtype).alias("__gmed")).checkpoint(eager=True)
    overall = found.where("whole").first()
    keyed = df.withColumn("__gk", F.to_json(F.struct(F.col(group).alias("g"))))
    joined = join_small(keyed, found.where("not whole").drop("whole"), ["__gk"], "left")
    return (joined.withColumn(col, F.coalesce(
        F.col(col), F.col("__gmed").cast(dtype),
        F.lit(overall["__gmed"] if overall else None).cast(dtype))).select(*df.columns))


def median_date_fill(df: DataFrame, col: str, nulls_counted: bool = False) -> DataFrame:
    """Null date -> lower median date (see ``ranking.lower_median``)."""
    med = lower_median(df, col, nulls_counted=nulls_counted).first()
    value = med["median"] if med else None
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value).cast("date")))


# --------------------------------------------------------------------------- full cleaning

# Fixed values of the snapshot format: relation-type variants and their codes.
CUSTOMER_TYPE_CODES = {"1.0": "1", "2.0": "2", "3.0": "3", "4.0": "4"}
# Province spelling fixed before encoding.
PROVINCE_FIXES = {"CORUÑA, A": "CORUNA, A"}


@dataclass
class SnapshotColumns:
    """Column roles of a raw snapshot.

    Fixed values: the defaults are the snapshot file's column names.
    ``categorical`` columns are the ones that ``encode`` codes after cleaning.
    """

    snapshot_date: str = "fecha_dato"
    customer: str = "ncodpers"
    age: str = "age"
    join_date: str = "fecha_alta"
    new_customer: str = "ind_nuevo"
    seniority: str = "antiguedad"
    relation: str = "indrel"
    last_primary_date: str = "ult_fec_cli_1t"
    relation_month: str = "indrel_1mes"
    relation_type: str = "tiprel_1mes"
    deceased: str = "indfall"
    province: str = "nomprov"
    activity: str = "ind_actividad_cliente"
    income: str = "renta"
    payroll_flags: list[str] = field(default_factory=lambda: ["ind_nomina_ult1",
                                                              "ind_nom_pens_ult1"])
    product_pattern: str = "ind_+.*ult.*"
    dropped_early: list[str] = field(default_factory=lambda: ["tipodom", "cod_prov"])
    dropped_late: list[str] = field(default_factory=lambda: [
        "fecha_dato", "fecha_alta", "ult_fec_cli_1t", "renta"])
    categorical: list[str] = field(default_factory=lambda: [
        "ind_empleado", "pais_residencia", "sexo", "indrel_1mes", "tiprel_1mes", "indresi",
        "indext", "conyuemp", "canal_entrada", "indfall", "nomprov", "segmento"])


def clean_snapshot(df: DataFrame, cols: SnapshotColumns | None = None,
                   age_bands: tuple[float, float, float] = (18, 30, 100),
                   date_nulls_counted: bool = False, drop_late: bool = True,
                   province_fixes: dict | None = None) -> DataFrame:
    """All fills, casts and drops of the snapshot; works on typed or all-text input.

    Numeric roles are coerced first, so a CSV scan and a typed table clean alike.
    Then all statistics come from two passes over one long form (metric, group,
    value): the age sums, the smallest seniority and quantile sketches, then the
    values around the medians.  The third read fills every column.

    Text columns keep their text here; category codes come from
    ``encode.category_dictionary`` / ``encode.encode_categories`` so that
    training and scoring data share one dictionary.
    """
    c = cols or SnapshotColumns()
    dates = [d for d in (c.snapshot_date, c.join_date, c.last_primary_date) if d in df.columns]
    products = select_by_regex(df, c.product_pattern).columns
    fixes = PROVINCE_FIXES if province_fixes is None else province_fixes
    fills = {c.new_customer: 1, c.relation: 1, **{f: 0 for f in c.payroll_flags if f in df.columns}}
    types = dict(df.dtypes)

    # row by row: conversions and constants
    rows = df.drop(*c.dropped_early).withColumns({
        **{d: X.parse_date(d) for d in dates},
        c.age: X.numeric_coerce(c.age),
        c.seniority: X.numeric_coerce(c.seniority),
        c.activity: _number(df, c.activity),
        c.income: _number(df, c.income, "double"),
        c.province: F.coalesce(X.replace_values(c.province, fixes), F.lit(UNKNOWN)),
        **{f: _number(df, f).cast("int") for f in products},
    })
    rows = rows.withColumn(c.last_primary_date, X.default_date(c.last_primary_date))
    rows = rows.withColumns({
        f: F.coalesce(_number(rows, f), F.lit(v).cast("int" if types[f] == "string" else types[f]))
        for f, v in fills.items()})

    # all statistics
    day = F.unix_date(c.join_date).cast("double")
    if date_nulls_counted:
        day = F.coalesce(day, F.lit(float("inf")))

    def entry(metric: str, value: Column, group: Column | None = None) -> Column:
        return F.struct(F.lit(metric).alias("metric"),
                        (F.lit(None).cast("string") if group is None else group).alias("grp"),
                        value.cast("double").alias("v"))

    entries = F.array(
        entry("age", F.col(c.age)), entry("seniority", F.col(c.seniority)),
        entry("day", day), entry("activity", F.col(c.activity)), entry("income", F.col(c.income)),
        entry("province", F.col(c.income), F.col(c.province)))
    long = rows.select(F.explode(entries).alias("e")).select("e.*")
    lo, mid, hi = age_bands
    found = middle(long, ["metric", "grp"], "v", [F.min("v").alias("least"),
                                                  *_age_sums("v", lo, mid, hi)])
    ensure_checkpoint_dir(df.sparkSession)
    found = found.checkpoint(eager=True)
    whole = {r["metric"]: r for r in found.where("metric <> 'province'").collect()}
    if not whole:  # an empty snapshot has nothing to fill
        whole = {m: Row(**{**dict.fromkeys(found.columns), "n_lt": 0, "n_gt": 0, "n1": 0, "n2": 0,
                           "n3": 0}) for m in ("age", "seniority", "day", "activity", "income")}

    def median(metric: str) -> float | None:
        r = whole[metric]
        return None if r["low"] is None else (r["low"] + r["high"]) / 2

    # fills
    first_day = whole["day"]["low"]
    fill_day = F.lit(None).cast("date") if first_day in (None, float("inf")) else \
        F.date_from_unix_date(F.lit(int(first_day)))
    by_province = found.where("metric = 'province' and n > 0").select(
        F.col("grp").alias(c.province), ((F.col("low") + F.col("high")) / 2).alias("__median"))
    types = dict(rows.dtypes)
    filled = join_small(rows, by_province, [c.province], "left")
    filled = filled.withColumns({
        c.age: _age_fill(F.col(c.age), whole["age"], lo, mid, hi),
        c.seniority: X.truncate_int(X.clamp_min(F.coalesce(
            F.col(c.seniority), F.lit(whole["seniority"]["least"]).cast("double")), 0.0)),
        c.join_date: F.coalesce(F.col(c.join_date), fill_day),
        c.activity: F.coalesce(F.col(c.activity),
                               F.lit(median("activity")).cast(types[c.activity])),
        c.income: F.coalesce(F.col(c.income), F.col("__median").cast(types[c.income]),
                             F.lit(median("income")).cast(types[c.income])),
    }).select(*rows.columns)
    filled = constant_fill(filled, {c.deceased: "N", c.relation_type: "A"})
    filled = code_map(filled, c.relation_month, CUSTOMER_TYPE_CODES, null_as="P")
    filled = unknown_fill(filled)
    filled = filled.withColumns({d: X.days_since(d) for d in dates})
    return drop_columns(filled, c.dropped_late) if drop_late else filled
