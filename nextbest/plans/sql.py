"""DuckDB oracle SQL fragments for the stand-in relations.

Each query of the registry is the same relation chain as its Spark plan,
written as plain ANSI SQL over the driver's views.
"""

from __future__ import annotations

from nextbest.plans import standins as S


def model_ctes(cutoff: str = S.TRAIN_CUTOFF, k: int = 7) -> str:
    """``with`` clause: train_orders .. ranked (the flagship chain)."""
    return f"""
with train_orders as (
  select o_orderkey, o_custkey as customer from orders
  where o_orderdate < timestamp '{cutoff}'
),
basket as (
  select distinct t.o_orderkey, t.customer, p.p_brand as product
  from train_orders t join lineitem l on l.l_orderkey = t.o_orderkey
  join part p on p.p_partkey = l.l_partkey
),
cattr as (
  select c_custkey as customer, c_nationkey, c_mktsegment,
         cast(floor(c_acctbal / 1000) as bigint) as acctbal_band
  from customer
),
attrs as (
  select customer, 'c_custkey' as attr, cast(customer as varchar) as value from cattr
  union all select customer, 'c_nationkey', cast(c_nationkey as varchar) from cattr
  union all select customer, 'c_mktsegment', c_mktsegment from cattr
  union all select customer, 'acctbal_band', cast(acctbal_band as varchar) from cattr
),
freq as (select product, count(*) as f from basket group by product),
tot as (select count(*) as n from train_orders),
afreq as (
  select a.attr, a.value, b.product, count(*) as c
  from basket b join attrs a on a.customer = b.customer
  group by a.attr, a.value, b.product
),
lik as (
  select a.attr, a.value, a.product, a.c, ln((a.c + 1.0) / (f.f + 1.0)) as ll
  from afreq a join freq f on f.product = a.product
),
prior as (
  select product, f, (select n from tot) as n,
         cast(f as double) / (select n from tot) as prior,
         ln(cast(f as double) / (select n from tot)) as log_prior
  from freq
),
score as (
  select s.customer, l.product, round(sum(l.ll) + max(p.log_prior), 9) as score
  from attrs s join lik l on l.attr = s.attr and l.value = s.value
  join prior p on p.product = l.product
  group by s.customer, l.product
),
hist as (select distinct customer, product from basket),
novel as (
  select s.* from score s
  where not exists (select 1 from hist h where h.customer = s.customer and h.product = s.product)
),
old as (
  select distinct n.customer from novel n
  where exists (select 1 from hist h where h.customer = n.customer)
),
fresh as (
  select s.* from score s where not exists (select 1 from old o where o.customer = s.customer)
),
cand as (
  select * from novel n where exists (select 1 from old o where o.customer = n.customer)
  union all select * from fresh
),
ranked_all as (
  select customer, product, score,
         row_number() over (partition by customer order by score desc, product) as rank
  from cand
),
ranked as (select * from ranked_all where rank <= {k})
"""


def actual_ctes(start: str = S.TRAIN_CUTOFF, end: str = S.ACTUAL_END) -> str:
    """Extra CTEs (append after ``model_ctes``): actual purchases, AP terms."""
    return f""",
later_orders as (
  select o_orderkey, o_custkey as customer from orders
  where o_orderdate >= timestamp '{start}' and o_orderdate < timestamp '{end}'
),
later as (
  select distinct t.customer, p.p_brand as product
  from later_orders t join lineitem l on l.l_orderkey = t.o_orderkey
  join part p on p.p_partkey = l.l_partkey
),
actual as (
  select * from later x
  where not exists (select 1 from hist h where h.customer = x.customer and h.product = x.product)
),
prec as (
  select r.customer, cast(r.rank as bigint) as rank, r.product as item,
         (a.customer is not null) as hit,
         sum(case when a.customer is not null then 1 else 0 end)
           over (partition by r.customer order by r.rank
                 rows between unbounded preceding and current row) as hits
  from ranked r left join actual a on a.customer = r.customer and a.product = r.product
),
nact as (select customer, count(*) as n_actual from actual group by customer),
ap as (
  select n.customer, cast(n.n_actual as bigint) as n_actual,
         coalesce(sum(case when p.hit then cast(p.hits as double) / p.rank end), 0.0)
           / least(n.n_actual, 7) as ap
  from nact n left join prec p on p.customer = n.customer
  group by n.customer, n.n_actual
)
"""


def snapshot_ctes(start: str = S.TRAIN_CUTOFF, end: str = S.ACTUAL_END) -> str:
    """Extra CTEs (append after ``model_ctes``): attributes of single orders, their model."""
    def attrs(where: str) -> str:
        return f"""
  select o_orderkey, o_custkey as customer, 'o_orderpriority' as attr, o_orderpriority as value
  from orders where {where}
  union all select o_orderkey, o_custkey, 'o_orderstatus', o_orderstatus from orders where {where}
  union all select o_orderkey, o_custkey, 'c_custkey', cast(o_custkey as varchar)
  from orders where {where}"""
    return f""",
sattr as ({attrs(f"o_orderdate < timestamp '{start}'")}),
sfacts as ({attrs(f"o_orderdate >= timestamp '{start}' and o_orderdate < timestamp '{end}'")}),
safreq as (
  select a.attr, a.value, b.product, count(*) as c
  from basket b join sattr a on a.o_orderkey = b.o_orderkey group by a.attr, a.value, b.product
),
slik as (
  select a.attr, a.value, a.product, a.c, ln((a.c + 1.0) / (f.f + 1.0)) as ll
  from safreq a join freq f on f.product = a.product
),
sscore as (
  select s.customer, l.product, round(sum(l.ll) + max(p.log_prior), 9) as score
  from sfacts s join slik l on l.attr = s.attr and l.value = s.value
  join prior p on p.product = l.product
  group by s.customer, l.product
)
"""


def raw_snapshot_cte() -> str:
    """``raw``: the raw-snapshot stand-in."""
    return """
with raw as (
  select
    strftime(cast(o.o_orderdate as date), '%Y-%m-%d') as fecha_dato,
    o.o_custkey as ncodpers,
    case when o.o_orderpriority = '5-LOW' and o.o_orderstatus = 'P' then '         NA'
         else ' ' || cast(cast(floor(o.o_totalprice / 4000) as bigint) as varchar) end as age,
    case when o.o_orderpriority = '1-URGENT' and o.o_orderstatus = 'F' then null
         else strftime(cast(o.o_orderdate as date)
                       - cast(cast(floor(o.o_totalprice) as bigint) % 3000 as integer),
                       '%Y-%m-%d') end as fecha_alta,
    case when o.o_orderpriority = '2-HIGH' and o.o_orderstatus = 'F' then null
         when o.o_orderstatus = 'O' then 1 else 0 end as ind_nuevo,
    case when o.o_orderpriority = '3-MEDIUM' and o.o_orderstatus = 'P' then 'NA'
         else '  ' || cast(cast(floor(date_diff('day', date '1996-01-01',
                                                cast(o.o_orderdate as date)) / 30) as bigint)
                           as varchar) end as antiguedad,
    case when o.o_orderpriority = '4-NOT SPECIFIED' and o.o_orderstatus = 'O' then null
         when o.o_orderstatus = 'P' then 99 else 1 end as indrel,
    case when o.o_orderpriority = '1-URGENT' and o.o_orderstatus = 'P'
         then strftime(cast(o.o_orderdate as date), '%Y-%m-%d') end as ult_fec_cli_1t,
    case o.o_orderpriority when '1-URGENT' then '1.0' when '2-HIGH' then '1'
         when '3-MEDIUM' then '3.0' when '4-NOT SPECIFIED' then 'P' end as indrel_1mes,
    case o.o_orderstatus when 'O' then 'A' when 'F' then 'I' end as tiprel_1mes,
    case when c.c_mktsegment in ('BUILDING', 'MACHINERY') then 'V' else 'H' end as sexo,
    cast(null as varchar) as conyuemp,
    case when c.c_acctbal <= 9000 then 'K' || substr(c.c_mktsegment, 1, 2) end as canal_entrada,
    case when o.o_orderpriority = '2-HIGH' and o.o_orderstatus = 'P' then null
         else 'N' end as indfall,
    1 as tipodom,
    c.c_nationkey as cod_prov,
    case when c.c_mktsegment = 'AUTOMOBILE' and o.o_orderstatus = 'P' then null
         else n.n_name end as nomprov,
    case when o.o_orderpriority = '5-LOW' and o.o_orderstatus = 'F' then null
         when o.o_orderstatus = 'O' then 1 else 0 end as ind_actividad_cliente,
    case when c.c_acctbal >= 0 then c.c_acctbal end as renta,
    c.c_mktsegment as segmento,
    case when o.o_orderpriority in ('1-URGENT', '2-HIGH') then 1 else 0 end as ind_cco_fin_ult1,
    case when o.o_orderpriority = '3-MEDIUM' and o.o_orderstatus = 'F' then null
         when o.o_totalprice > 250000 then 1 else 0 end as ind_nomina_ult1,
    case when o.o_orderpriority = '4-NOT SPECIFIED' and o.o_orderstatus = 'P' then null
         when o.o_orderstatus = 'F' then 1 else 0 end as ind_nom_pens_ult1
  from orders o join customer c on c.c_custkey = o.o_custkey
  join nation n on n.n_nationkey = c.c_nationkey
)
"""


# The brands of the test tables (the Spark side reads them from ``part``).
BRANDS = [f"Brand#{i}" for i in range(1, 26)]


def brand_flags_sql(columns: list[str]) -> str:
    """One row per order, all orders, with the given 0/1 brand columns."""
    cols = ",\n    ".join(
        f"cast(coalesce(max(case when p.p_brand = '{p}' then 1 end), 0) as integer) as \"{p}\""
        for p in columns)
    return f"""
  select o.o_orderkey, o.o_custkey as customer,
    {cols}
  from orders o left join lineitem l on l.l_orderkey = o.o_orderkey
  left join part p on p.p_partkey = l.l_partkey
  group by o.o_orderkey, o.o_custkey
"""
