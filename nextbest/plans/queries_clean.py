"""Registry entries for cleaning, encoding, wide-flag and text-record operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from nextbest.functions import scalars as X
from nextbest.operators import clean, encode, features
from nextbest.plans import pipeline as P
from nextbest.plans import sql as Q
from nextbest.plans import standins as S
from nextbest.plans.queries import register
from nextbest.session import ensure_checkpoint_dir
from nextbest.sources import records

RAW = Q.raw_snapshot_cte()
# Stand-in of the province spelling fix: one nation name has a variant spelling.
NATION_FIXES = {"NATION_7": "NATION_07"}
# Stand-in bands for age-like p_size (1..50) in place of 18 / 30 / 100.
SIZE_BANDS = (10, 20, 45)
# The last one is a date: values after the training split are unseen and get code 0.
DICT_COLS = ["indrel_1mes", "tiprel_1mes", "sexo", "canal_entrada", "nomprov", "segmento",
             "ult_fec_cli_1t"]


def _raw(spark, sf):
    return S.raw_snapshot(S.Tables(spark, sf))


def _r9(c):
    return F.round(c, 9)


# --------------------------------------------------------------------------- text scan

@register("scan_na_tokens", RAW + """
select fecha_dato, ncodpers,
  case when trim(age) in ('-999999', 'NA', '') then null else age end as age,
  case when trim(antiguedad) in ('-999999', 'NA', '') then null else antiguedad end as antiguedad,
  case when trim(fecha_alta) in ('-999999', 'NA', '') then null else fecha_alta end as fecha_alta
from raw""")
def q_scan_na_tokens(spark, sf):
    raw = _raw(spark, sf).select("fecha_dato", "ncodpers", "age", "antiguedad", "fecha_alta")
    return records.null_tokens(raw)


_PART_TEXT = """
with ptxt as (
  select p_partkey,
         case when p_size % 7 = 0 then 'NA'
              when p_size % 13 = 0 then 'x' || cast(p_size as varchar)
              when p_size % 11 = 0 then cast(p_size as varchar) || 'd'
              when p_size % 17 = 0 then 'NaN'
              when p_size % 19 = 0 then '0x1p3'
              when p_size % 5 = 0 then cast(p_size as varchar) || '.0 '
              else ' ' || cast(p_size as varchar) end as size_txt
  from part
)
"""
# DuckDB's cast takes neither a type suffix nor a hexadecimal float, but it takes NaN.
_SIZE_NUM = "case when trim(size_txt) <> 'NaN' then try_cast(trim(size_txt) as double) end"


def _part_text(spark, sf):
    p = S.Tables(spark, sf).read("part", ["p_partkey", "p_size"])
    txt = (F.when(F.col("p_size") % 7 == 0, F.lit("NA"))
           .when(F.col("p_size") % 13 == 0, F.concat(F.lit("x"), F.col("p_size").cast("string")))
           .when(F.col("p_size") % 11 == 0, F.concat(F.col("p_size").cast("string"), F.lit("d")))
           .when(F.col("p_size") % 17 == 0, F.lit("NaN"))
           .when(F.col("p_size") % 19 == 0, F.lit("0x1p3"))
           .when(F.col("p_size") % 5 == 0, F.concat(F.col("p_size").cast("string"), F.lit(".0 ")))
           .otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string"))))
    return p.select("p_partkey", txt.alias("size_txt"))


@register("numeric_coerce", _PART_TEXT + f"""
select p_partkey, size_txt, {_SIZE_NUM} as size_num from ptxt""")
def q_numeric_coerce(spark, sf):
    return _part_text(spark, sf).withColumn("size_num", X.numeric_coerce("size_txt"))


@register("drop_null_records", _PART_TEXT + f"""
select p_partkey, {_SIZE_NUM} as size_num from ptxt where {_SIZE_NUM} is not null""")
def q_drop_null_records(spark, sf):
    df = _part_text(spark, sf).select("p_partkey", X.numeric_coerce("size_txt").alias("size_num"))
    return clean.drop_null_records(df, ["size_num"])


@register("age_normalize", _PART_TEXT + f"""
, a0 as (select p_partkey, {_SIZE_NUM} as a from ptxt),
m1 as (select avg(a) as v from a0 where a between {SIZE_BANDS[0]} and {SIZE_BANDS[1]}),
a1 as (select p_partkey, case when a < {SIZE_BANDS[0]} then (select v from m1) else a end as a
       from a0),
m2 as (select avg(a) as v from a1 where a between {SIZE_BANDS[1]} and {SIZE_BANDS[2]}),
a2 as (select p_partkey, case when a > {SIZE_BANDS[2]} then (select v from m2) else a end as a
       from a1),
m3 as (select avg(a) as v from a2)
select p_partkey, cast(trunc(coalesce(a, (select v from m3))) as integer) as size_txt from a2""")
def q_age_normalize(spark, sf):
    lo, mid, hi = SIZE_BANDS
    return clean.age_normalize(_part_text(spark, sf), "size_txt", lo, mid, hi)


# --------------------------------------------------------------------------- customer fills

_CUST = """
with cust as (
  select c_custkey, c_nationkey,
         case when c_mktsegment = 'HOUSEHOLD' then null else c_acctbal end as bal,
         case when c_mktsegment = 'BUILDING' then 'NA'
              else cast(cast(floor(c_acctbal / 100) as bigint) as varchar) end as sen
  from customer
)
"""


def _cust(spark, sf):
    c = S.Tables(spark, sf).read("customer", ["c_custkey", "c_nationkey", "c_acctbal",
                                               "c_mktsegment"])
    return c.select(
        "c_custkey", "c_nationkey",
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_acctbal")).alias("bal"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("NA"))
        .otherwise(F.floor(F.col("c_acctbal") / 100).cast("bigint").cast("string")).alias("sen"))


@register("conditional_update", """
select c_custkey, case when c_acctbal < 0 then 0.0 else c_acctbal end as c_acctbal
from customer""")
def q_conditional_update(spark, sf):
    c = S.Tables(spark, sf).read("customer", ["c_custkey", "c_acctbal"])
    return clean.conditional_update(c, "c_acctbal", F.col("c_acctbal") < 0, 0.0)


@register("canonicalize_value", """
select c.c_custkey, case when n.n_name = 'NATION_7' then 'NATION_07' else n.n_name end as n_name
from customer c join nation n on n.n_nationkey = c.c_nationkey""")
def q_canonicalize_value(spark, sf):
    t = S.Tables(spark, sf)
    c = t.read("customer", ["c_custkey", "c_nationkey"])
    n = t.read("nation", ["n_nationkey", "n_name"])
    j = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")
    return clean.canonicalize_value(j, "n_name", NATION_FIXES)


@register("seniority_fill", _CUST + """
, m as (select min(try_cast(trim(sen) as double)) as v from cust),
f as (select c_custkey, coalesce(try_cast(trim(sen) as double), (select v from m)) as s from cust)
select c_custkey, cast(trunc(case when s < 0 then 0 else s end) as integer) as sen from f""")
def q_seniority_fill(spark, sf):
    return clean.seniority_fill(_cust(spark, sf), "sen").select("c_custkey", "sen")


@register("median_fill", _CUST + """
select c_custkey, round(coalesce(bal, (select median(bal) from cust)), 9) as bal from cust""")
def q_median_fill(spark, sf):
    out = clean.median_fill(_cust(spark, sf), "bal")
    return out.select("c_custkey", _r9(F.col("bal")).alias("bal"))


@register("group_median_fill", _CUST + """
, g as (select c_nationkey, median(bal) as v from cust group by c_nationkey)
select c.c_custkey, c.c_nationkey,
       round(coalesce(c.bal, g.v, (select median(bal) from cust)), 9) as bal
from cust c left join g on g.c_nationkey = c.c_nationkey""")
def q_group_median_fill(spark, sf):
    out = clean.group_median_fill(_cust(spark, sf), "bal", "c_nationkey")
    return out.select("c_custkey", "c_nationkey", _r9(F.col("bal")).alias("bal"))


# --------------------------------------------------------------------------- snapshot columns

@register("code_map", RAW + """
select fecha_dato, ncodpers,
  case coalesce(indrel_1mes, 'P')
    when '1.0' then '1' when '1' then '1' when '2.0' then '2' when '2' then '2'
    when '3.0' then '3' when '3' then '3' when '4.0' then '4' when '4' then '4'
    when 'P' then 'P' else coalesce(indrel_1mes, 'P') end as indrel_1mes
from raw""")
def q_code_map(spark, sf):
    raw = _raw(spark, sf).select("fecha_dato", "ncodpers", "indrel_1mes")
    return clean.code_map(raw, "indrel_1mes", clean.CUSTOMER_TYPE_CODES, null_as="P")


@register("constant_fill", RAW + """
select fecha_dato, ncodpers, coalesce(ind_nuevo, 1) as ind_nuevo, coalesce(indrel, 1) as indrel,
       coalesce(indfall, 'N') as indfall, coalesce(tiprel_1mes, 'A') as tiprel_1mes,
       coalesce(conyuemp, 'UNKNOWN') as conyuemp
from raw""")
def q_constant_fill(spark, sf):
    raw = _raw(spark, sf).select("fecha_dato", "ncodpers", "ind_nuevo", "indrel", "indfall",
                                 "tiprel_1mes", "conyuemp")
    filled = clean.constant_fill(raw, {"ind_nuevo": 1, "indrel": 1, "indfall": "N",
                                       "tiprel_1mes": "A"})
    return clean.unknown_fill(filled, ["conyuemp"])


_RAW_COLS = ["fecha_dato", "ncodpers", "age", "fecha_alta", "ind_nuevo", "antiguedad", "indrel",
             "ult_fec_cli_1t", "indrel_1mes", "tiprel_1mes", "sexo", "conyuemp",
             "canal_entrada", "indfall", "tipodom", "cod_prov", "nomprov",
             "ind_actividad_cliente", "renta", "segmento", "ind_cco_fin_ult1",
             "ind_nomina_ult1", "ind_nom_pens_ult1"]


@register("null_profile", RAW + "select " + ", ".join(
    f"coalesce(bool_or({c} is null), false) as {c}" for c in _RAW_COLS) + " from raw")
def q_null_profile(spark, sf):
    return clean.null_profile(_raw(spark, sf))


@register("drop_columns", RAW + "select " + ", ".join(
    c for c in _RAW_COLS if c not in ("tipodom", "cod_prov")) + " from raw")
def q_drop_columns(spark, sf):
    return clean.drop_columns(_raw(spark, sf), ["tipodom", "cod_prov"])


@register("parse_dates", RAW + """
select fecha_dato as fecha_txt, ncodpers,
       cast(try_strptime(trim(fecha_dato), '%Y-%m-%d') as date) as fecha_dato,
       cast(try_strptime(trim(fecha_alta), '%Y-%m-%d') as date) as fecha_alta
from raw""")
def q_parse_dates(spark, sf):
    raw = _raw(spark, sf)
    return raw.select(F.col("fecha_dato").alias("fecha_txt"), "ncodpers",
                      X.parse_date("fecha_dato").alias("fecha_dato"),
                      X.parse_date("fecha_alta").alias("fecha_alta"))


@register("default_date", RAW + """
select fecha_dato, ncodpers,
       coalesce(cast(try_strptime(trim(ult_fec_cli_1t), '%Y-%m-%d') as date), date '2015-01-28')
         as ult_fec_cli_1t
from raw""")
def q_default_date(spark, sf):
    raw = _raw(spark, sf)
    return raw.select("fecha_dato", "ncodpers",
                      X.default_date(X.parse_date("ult_fec_cli_1t")).alias("ult_fec_cli_1t"))


@register("days_since_base", RAW + """
select fecha_dato as fecha_txt, ncodpers,
       cast(date_diff('day', date '1902-01-01',
                      cast(try_strptime(trim(fecha_dato), '%Y-%m-%d') as date)) as bigint)
         as fecha_dato
from raw""")
def q_days_since_base(spark, sf):
    raw = _raw(spark, sf)
    return raw.select(F.col("fecha_dato").alias("fecha_txt"), "ncodpers",
                      X.days_since(X.parse_date("fecha_dato")).cast("bigint").alias("fecha_dato"))


@register("median_date_fill", RAW + """
, d as (select fecha_dato, ncodpers,
               cast(try_strptime(trim(fecha_alta), '%Y-%m-%d') as date) as fecha_alta from raw)
select fecha_dato, ncodpers,
       coalesce(fecha_alta, (select percentile_disc(0.5) within group (order by fecha_alta)
                             from d where fecha_alta is not null)) as fecha_alta
from d""")
def q_median_date_fill(spark, sf):
    raw = _raw(spark, sf).select("fecha_dato", "ncodpers",
                                 X.parse_date("fecha_alta").alias("fecha_alta"))
    return clean.median_date_fill(raw, "fecha_alta")


@register("sort_snapshot", RAW + """
select fecha_dato, ncodpers, age from raw order by fecha_dato, ncodpers""")
def q_sort_snapshot(spark, sf):
    return clean.sort_snapshot(_raw(spark, sf).select("fecha_dato", "ncodpers", "age"),
                               ["fecha_dato", "ncodpers"])


# --------------------------------------------------------------------------- wide flags

def _flags(spark, sf):
    return S.brand_flags(S.Tables(spark, sf), cutoff=None)


@register("cast_flags", Q.brand_flags_sql(Q.BRANDS))
def q_cast_flags(spark, sf):
    wide = _flags(spark, sf)
    brands = wide.columns[2:]
    # flags as a text scan gives them: plain, decimal and padded
    text = wide.withColumns({b: F.concat(F.col(f"`{b}`"), F.lit(["", ".0", " "][i % 3]))
                             for i, b in enumerate(brands)})
    return clean.cast_flags(text, brands)


_REGEX = "Brand#1[0-9]*"


@register("select_by_regex", "select o_orderkey, " + ", ".join(
    f'"{b}"' for b in Q.BRANDS if b.startswith("Brand#1"))
    + f" from ({Q.brand_flags_sql([b for b in Q.BRANDS if b.startswith('Brand#1')])})")
def q_select_by_regex(spark, sf):
    return clean.select_by_regex(_flags(spark, sf), _REGEX, keep=["o_orderkey"])


@register("purchase_long", """
select distinct o.o_orderkey, o.o_custkey as customer, p.p_brand as product
from orders o join lineitem l on l.l_orderkey = o.o_orderkey
join part p on p.p_partkey = l.l_partkey""")
def q_purchase_long(spark, sf):
    wide = _flags(spark, sf)
    return features.purchase_long(wide, ["o_orderkey", "customer"], wide.columns[2:])


# --------------------------------------------------------------------------- dictionary

_DICT_SQL = RAW + """,
train as (select * from raw where fecha_dato < '1996-01-01'),
long as (
""" + "\n  union all\n".join(
    f"  select '{c}' as col, {c} as value, fecha_dato, ncodpers from train where {c} is not null"
    for c in DICT_COLS) + """
),
firsts as (
  select col, value, fecha_dato, ncodpers from (
    select *, row_number() over (partition by col, value order by fecha_dato, ncodpers) as r
    from long) x where r = 1
),
dict as (
  select col as "column", value,
         cast(row_number() over (partition by col order by fecha_dato, ncodpers, value)
              as integer) as code
  from firsts
)
"""


def _dictionary(spark, sf):
    raw = _raw(spark, sf)
    train = raw.where(F.col("fecha_dato") < "1996-01-01")
    return raw, encode.category_dictionary(train, DICT_COLS, ["fecha_dato", "ncodpers"])


@register("category_dictionary", _DICT_SQL + 'select "column", value, code from dict')
def q_category_dictionary(spark, sf):
    return _dictionary(spark, sf)[1]


@register("encode_categories", _DICT_SQL + "select r.fecha_dato, r.ncodpers, " + ", ".join(
    f"case when r.{c} is null then null else coalesce(d{i}.code, 0) end as {c}"
    for i, c in enumerate(DICT_COLS)) + " from raw r " + " ".join(
    f"left join dict d{i} on d{i}.\"column\" = '{c}' and d{i}.value = r.{c}"
    for i, c in enumerate(DICT_COLS)))
def q_encode_categories(spark, sf):
    raw, d = _dictionary(spark, sf)
    out = encode.encode_categories(raw.select("fecha_dato", "ncodpers", *DICT_COLS), d,
                                   DICT_COLS, unseen_code=0)
    return out


# --------------------------------------------------------------------------- full cleaning

_CLEAN_SQL = RAW + f"""
, t1 as (
  select ncodpers,
    cast(try_strptime(trim(fecha_dato), '%Y-%m-%d') as date) as dato,
    try_cast(trim(age) as double) as age_n,
    cast(try_strptime(trim(fecha_alta), '%Y-%m-%d') as date) as alta,
    ind_nuevo, try_cast(trim(antiguedad) as double) as sen_n, indrel,
    coalesce(cast(try_strptime(trim(ult_fec_cli_1t), '%Y-%m-%d') as date), date '2015-01-28')
      as ult,
    indrel_1mes, tiprel_1mes, sexo, conyuemp, canal_entrada, indfall, nomprov,
    ind_actividad_cliente, renta, segmento, ind_cco_fin_ult1, ind_nomina_ult1, ind_nom_pens_ult1
  from raw
),
m1 as (select avg(age_n) as v from t1 where age_n between 18 and 30),
a1 as (select t1.*, case when age_n < 18 then (select v from m1) else age_n end as age1 from t1),
m2 as (select avg(age1) as v from a1 where age1 between 30 and 100),
a2 as (select a1.*, case when age1 > 100 then (select v from m2) else age1 end as age2 from a1),
m3 as (select avg(age2) as v from a2),
sen as (select min(sen_n) as v from t1),
alta_med as (select percentile_disc(0.5) within group (order by alta) as v from t1
             where alta is not null),
act_med as (select median(ind_actividad_cliente) as v from t1),
p as (
  select a2.*, coalesce(case when nomprov = 'NATION_7' then 'NATION_07' else nomprov end,
                        'UNKNOWN') as prov
  from a2
),
gmed as (select prov, median(renta) as v from p group by prov),
omed as (select median(renta) as v from p)
select
  cast(date_diff('day', date '1902-01-01', p.dato) as bigint) as fecha_dato,
  p.ncodpers,
  cast(trunc(coalesce(p.age2, (select v from m3))) as integer) as age,
  cast(date_diff('day', date '1902-01-01', coalesce(p.alta, (select v from alta_med))) as bigint)
    as fecha_alta,
  coalesce(p.ind_nuevo, 1) as ind_nuevo,
  cast(trunc(case when coalesce(p.sen_n, (select v from sen)) < 0 then 0
                  else coalesce(p.sen_n, (select v from sen)) end) as integer) as antiguedad,
  coalesce(p.indrel, 1) as indrel,
  cast(date_diff('day', date '1902-01-01', p.ult) as bigint) as ult_fec_cli_1t,
  case coalesce(p.indrel_1mes, 'P')
    when '1.0' then '1' when '1' then '1' when '2.0' then '2' when '2' then '2'
    when '3.0' then '3' when '3' then '3' when '4.0' then '4' when '4' then '4'
    when 'P' then 'P' else coalesce(p.indrel_1mes, 'P') end as indrel_1mes,
  coalesce(p.tiprel_1mes, 'A') as tiprel_1mes,
  coalesce(p.sexo, 'UNKNOWN') as sexo,
  coalesce(p.conyuemp, 'UNKNOWN') as conyuemp,
  coalesce(p.canal_entrada, 'UNKNOWN') as canal_entrada,
  coalesce(p.indfall, 'N') as indfall,
  p.prov as nomprov,
  coalesce(p.ind_actividad_cliente,
           cast(trunc((select v from act_med)) as integer)) as ind_actividad_cliente,
  round(coalesce(p.renta, g.v, (select v from omed)), 9) as renta,
  coalesce(p.segmento, 'UNKNOWN') as segmento,
  p.ind_cco_fin_ult1,
  coalesce(p.ind_nomina_ult1, 0) as ind_nomina_ult1,
  coalesce(p.ind_nom_pens_ult1, 0) as ind_nom_pens_ult1
from p left join gmed g on g.prov = p.prov
"""


@register("clean_snapshot", _CLEAN_SQL)
def q_clean_snapshot(spark, sf):
    out = clean.clean_snapshot(_raw(spark, sf), drop_late=False, province_fixes=NATION_FIXES)
    return out.withColumns({
        "fecha_dato": F.col("fecha_dato").cast("bigint"),
        "fecha_alta": F.col("fecha_alta").cast("bigint"),
        "ult_fec_cli_1t": F.col("ult_fec_cli_1t").cast("bigint"),
        "renta": _r9(F.col("renta")),
    })


# --------------------------------------------------------------------------- from files to files

_PRODUCTS = ["ind_cco_fin_ult1", "ind_nomina_ult1", "ind_nom_pens_ult1"]
_ATTRS = ["age", "ind_nuevo", "antiguedad", "indrel", "indrel_1mes", "tiprel_1mes", "sexo",
          "conyuemp", "canal_entrada", "indfall", "nomprov", "ind_actividad_cliente", "segmento"]


def _files_sql() -> str:
    """Both splits cleaned on their own, then the model on text values.

    The codes of the Spark side are a relabelling of the training values, and a
    value without a code matches nothing, so the text values give the same scores.
    """
    raw0 = RAW.replace("with raw as", "with raw0 as", 1)
    body = _CLEAN_SQL[len(RAW):]

    def cleaned(where: str) -> str:
        return f"(with raw as (select * from raw0 where {where}){body})"

    def long(table: str) -> str:
        return "\n  union all ".join(
            f"select rid, ncodpers as customer, '{a}' as attr, cast({a} as varchar) as value"
            f" from {table}" for a in [*_ATTRS, "ncodpers"])

    def owned(table: str) -> str:
        return "\n  union all ".join(
            f"select rid, ncodpers as customer, '{p}' as product from {table} where {p} = 1"
            for p in _PRODUCTS)

    return f"""{raw0},
tr as materialized (select row_number() over () as rid, * from {cleaned(
        f"fecha_dato < '{S.TRAIN_CUTOFF}'")}),
te as materialized (select row_number() over () as rid, * from {cleaned(
        f"fecha_dato between '{S.TRAIN_CUTOFF}' and '{S.ACTUAL_LAST}'")}),
tr_own as materialized ({owned('tr')}),
freq as (select product, count(*) as f from tr_own group by product),
prior as (select product, ln(cast(f as double) / (select count(*) from tr)) as log_prior from freq),
afreq as (select attr, value, product, count(*) as c from ({long('tr')}) a
  join tr_own o using (rid) group by all),
lik as (select attr, value, product, ln((c + 1.0) / (f + 1.0)) as ll from afreq join freq using (product)),
score as materialized (select customer, product, round(sum(ll) + max(log_prior), 9) as score
  from ({long('te')}) t join lik using (attr, value) join prior using (product)
  group by customer, product),
hist as (select distinct customer, product from tr_own),
marked as (select s.*, h.customer is not null as owned,
    bool_or(h.customer is null) over (partition by s.customer) as novel
  from score s left join hist h on h.customer = s.customer and h.product = s.product),
ranked as materialized (select customer, product, row_number() over (
    partition by customer order by score desc, product) as rank
  from marked where not owned or not novel),
actual as materialized (select distinct customer, product from ({owned('te')}) x
  where not exists (select 1 from hist h where h.customer = x.customer and h.product = x.product)),
hits as (select r.customer, r.rank, row_number() over (partition by r.customer order by r.rank) as h
  from ranked r join actual using (customer, product) where r.rank <= 7),
ap as (select a.customer, coalesce(any_value(s), 0) / least(count(*), 7) as ap
  from actual a left join (select customer, sum(cast(h as double) / rank) as s from hits
    group by customer) x using (customer) group by a.customer)
select (select count(*) from tr) as n_train, (select count(*) from te) as n_test,
  (select count(distinct customer) from ranked) as n_ranked_customers,
  (select count(*) from ranked where rank <= 7) as n_recommendations,
  count(*) as n_evaluated, round(avg(ap), 9) as map_at_k
from ap"""


@register("pipeline_end_to_end", _files_sql())
def q_pipeline_end_to_end(spark, sf):
    folder = f"{ensure_checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"
    out = P.standin_from_files(S.Tables(spark, sf), folder, province_fixes=NATION_FIXES)
    return out.withColumn("map_at_k", _r9(F.col("map_at_k")))


# --------------------------------------------------------------------------- line records

_LINES = """
with lines as (
  select o_orderkey,
    case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then ''
         when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'P'
           then 'o_orderkey,o_custkey,o_orderstatus,o_orderpriority'
         else cast(o_orderkey as varchar) || ', ' || cast(o_custkey as varchar) || ' ,'
              || o_orderstatus || ',' || o_orderpriority end as value
  from orders
)
"""


@register("parse_lines", _LINES + """
select trim(split_part(value, ',', 1)) as o_orderkey, trim(split_part(value, ',', 2)) as o_custkey,
       trim(split_part(value, ',', 3)) as o_orderstatus,
       trim(split_part(value, ',', 4)) as o_orderpriority
from lines where length(trim(value)) > 0 and not contains(value, 'o_orderstatus')""")
def q_parse_lines(spark, sf):
    o = S.Tables(spark, sf).read("orders", ["o_orderkey", "o_custkey", "o_orderstatus",
                                             "o_orderpriority"])
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    text = (F.when((pr == "5-LOW") & (st == "P"), F.lit(""))
            .when((pr == "4-NOT SPECIFIED") & (st == "P"),
                  F.lit("o_orderkey,o_custkey,o_orderstatus,o_orderpriority"))
            .otherwise(F.concat_ws(",", F.col("o_orderkey").cast("string"),
                                   F.concat(F.lit(" "), F.col("o_custkey").cast("string"),
                                            F.lit(" ")), st, pr)))
    lines = o.select(text.alias("value"))
    return records.parse_lines(lines, ["o_orderkey", "o_custkey", "o_orderstatus",
                                       "o_orderpriority"], header_marker="o_orderstatus")

