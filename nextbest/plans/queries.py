"""Query registry: one Spark plan and one DuckDB oracle per operator.

Every query reads the driver's tables in ``sf_dir`` whole; nothing is sampled
or capped (``k`` in top-k is the feature itself).  Doubles that come out of a
floating-point sum or a logarithm are rounded to 9 decimals in both engines so
the comparison does not depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nextbest.operators import bayes, evaluate, features, recommend
from nextbest.plans import pipeline as P
from nextbest.plans import sql as Q
from nextbest.plans import standins as S
from nextbest.sources import records

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}
K = recommend.DEFAULT_K


def register(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


def _r9(c) -> "F.Column":
    return F.round(c, 9)


# --------------------------------------------------------------------------- model

@register("total_instances", Q.model_ctes() + "select count(*) as n from train_orders")
def q_total_instances(spark, sf):
    t = S.Tables(spark, sf)
    return bayes.total_instances(S.orders_between(t, None, S.TRAIN_CUTOFF)) \
        .select(F.col("n").cast("bigint").alias("n"))


@register("product_frequency", Q.model_ctes() + "select product, f from freq")
def q_product_frequency(spark, sf):
    t = S.Tables(spark, sf)
    facts = S.basket(t, S.orders_between(t, None, S.TRAIN_CUTOFF))
    return bayes.product_frequency(facts, weight=None)


@register("product_prior", Q.model_ctes() + """
select product, f, n, round(prior, 9) as prior, round(log_prior, 9) as log_prior from prior""")
def q_product_prior(spark, sf):
    t = S.Tables(spark, sf)
    orders = S.orders_between(t, None, S.TRAIN_CUTOFF)
    freq = bayes.product_frequency(S.basket(t, orders), weight=None)
    prior = bayes.product_prior(freq, bayes.total_instances(orders).scalar())
    return prior.select("product", "f", "n", _r9(F.col("prior")).alias("prior"),
                        _r9(F.col("log_prior")).alias("log_prior"))


@register("attr_frequency", Q.model_ctes() + "select attr, value, product, c from afreq")
def q_attr_frequency(spark, sf):
    return P.fit_standin(S.Tables(spark, sf)).model.likelihood.select(
        "attr", "value", "product", "c")


@register("nb_likelihood", Q.model_ctes() + """
select attr, value, product, c, round(ll, 9) as ll from lik""")
def q_nb_likelihood(spark, sf):
    lik = P.fit_standin(S.Tables(spark, sf)).model.likelihood
    return lik.select("attr", "value", "product", "c", _r9(F.col("ll")).alias("ll"))


@register("attr_long", Q.model_ctes() + "select customer, attr, value from attrs")
def q_attr_long(spark, sf):
    attrs = S.customer_attributes(S.Tables(spark, sf))
    return bayes.scoring_facts(attrs, S.ATTR_COLS, S.ID_ATTR)


@register("attr_long_types", """
with c as (
  select c_custkey, c_nationkey as as_int,
         case when c_mktsegment <> 'HOUSEHOLD' then floor(c_acctbal / 1000) end as as_double,
         case when c_mktsegment <> 'BUILDING' then c_mktsegment end as as_text
  from customer
)
select c_custkey, 'as_int' as attr, cast(as_int as varchar) as value from c
union all select c_custkey, 'as_double', coalesce(cast(cast(as_double as bigint) as varchar), '') from c
union all select c_custkey, 'as_decimal', coalesce(cast(cast(as_double as bigint) as varchar), '') from c
union all select c_custkey, 'as_text', coalesce(as_text, '') from c""")
def q_attr_long_types(spark, sf):
    c = S.Tables(spark, sf).read("customer", ["c_custkey", "c_nationkey", "c_acctbal",
                                               "c_mktsegment"])
    number = F.when(F.col("c_mktsegment") != "HOUSEHOLD",
                    F.floor(F.col("c_acctbal") / 1000).cast("double"))
    cols = c.select("c_custkey", F.col("c_nationkey").cast("int").alias("as_int"),
                    number.alias("as_double"), number.cast("decimal(12,2)").alias("as_decimal"),
                    F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("as_text"))
    return features.attr_long(cols, ["c_custkey"], cols.columns[1:])


@register("purchase_history", Q.model_ctes() + """
select customer, cast(count(*) as bigint) as n_products,
       string_agg(product, ' ' order by product) as items
from hist group by customer""")
def q_purchase_history(spark, sf):
    t = S.Tables(spark, sf)
    facts = S.basket(t, S.orders_between(t, None, S.TRAIN_CUTOFF))
    lists = features.purchase_lists(features.purchase_history(facts))
    return lists.select("customer", F.size("items").cast("bigint").alias("n_products"),
                        F.concat_ws(" ", "items").alias("items"))


@register("nb_score", Q.model_ctes() + "select customer, product, score from score")
def q_nb_score(spark, sf):
    return P.score_standin(P.fit_standin(S.Tables(spark, sf)))


@register("posterior_prob", Q.model_ctes() + """
select customer, product, score, printf('%.6e', exp(score)) as posterior from score""")
def q_posterior_prob(spark, sf):
    scored = bayes.posterior_prob(P.score_standin(P.fit_standin(S.Tables(spark, sf))))
    return scored.select("customer", "product", "score",
                         F.format_string("%.6e", "posterior").alias("posterior"))


# --------------------------------------------------------------------------- candidates

def _scores_and_history(spark, sf, cutoff=S.TRAIN_CUTOFF):
    fitted = P.fit_standin(S.Tables(spark, sf), cutoff)
    return P.score_standin(fitted), P.history(fitted)


@register("exclude_owned", Q.model_ctes() + "select customer, product, score from novel")
def q_exclude_owned(spark, sf):
    scores, hist = _scores_and_history(spark, sf)
    return recommend.exclude_owned(scores, hist)


@register("new_customers", Q.model_ctes() + "select customer, product, score from fresh")
def q_new_customers(spark, sf):
    scores, hist = _scores_and_history(spark, sf)
    return recommend.new_customers(scores, hist)


@register("all_candidates", Q.model_ctes() + "select customer, product, score from cand")
def q_all_candidates(spark, sf):
    scores, hist = _scores_and_history(spark, sf)
    return recommend.all_candidates(scores, hist)


_TOPK_SQL = "select customer, cast(rank as bigint) as rank, product, score from ranked"


@register("recommend_topk", Q.model_ctes() + _TOPK_SQL)
def q_recommend_topk(spark, sf):
    return P.recommend_standin(S.Tables(spark, sf), S.TRAIN_CUTOFF, K)


@register("recommend_exhausted", Q.model_ctes(S.LATE_CUTOFF) + _TOPK_SQL)
def q_recommend_exhausted(spark, sf):
    return P.recommend_standin(S.Tables(spark, sf), S.LATE_CUTOFF, K)


@register("collect_predictions", Q.model_ctes() + """
select customer, cast(count(*) as bigint) as n_candidates,
       string_agg(product, ' ' order by rank) as items
from ranked_all group by customer""")
def q_collect_predictions(spark, sf):
    scores, hist = _scores_and_history(spark, sf)
    cands = recommend.all_candidates(scores, hist)
    ranked = recommend.recommend_topk(cands, k=None)
    lists = recommend.collect_predictions(ranked)
    return lists.select("customer", F.size("items").cast("bigint").alias("n_candidates"),
                        F.concat_ws(" ", "items").alias("items"))


@register("truncate_list", Q.model_ctes() + f"""
select customer, string_agg(product, ' ' order by rank) as items
from ranked_all where rank <= {K} group by customer""")
def q_truncate_list(spark, sf):
    scores, hist = _scores_and_history(spark, sf)
    ranked = recommend.recommend_topk(recommend.all_candidates(scores, hist), k=None)
    lists = recommend.truncate_list(recommend.collect_predictions(ranked), K)
    return lists.select("customer", F.concat_ws(" ", "items").alias("items"))


def _topk_records(spark, sf):
    return recommend.collect_predictions(P.recommend_standin(S.Tables(spark, sf)))


_RECORD_SQL = Q.model_ctes() + """,
rec as (
  select customer, cast(customer as varchar) || ',' || string_agg(product, ' ' order by rank)
         as value
  from ranked group by customer
)
"""


@register("format_ranked_list", _RECORD_SQL + "select customer, value from rec")
def q_format_ranked_list(spark, sf):
    return records.format_ranked_list(_topk_records(spark, sf), keep_id=True)


@register("sort_records", _RECORD_SQL + "select customer, value from rec order by customer")
def q_sort_records(spark, sf):
    recs = _topk_records(spark, sf)
    text = records.format_ranked_list(recs.select("customer", "items"))
    parsed = text.select(F.split("value", ",", 2).getItem(0).alias("customer"), "value")
    return recommend.sort_records(parsed).select(
        F.col("customer").cast("bigint").alias("customer"), "value")


@register("parse_ranked_list", _RECORD_SQL + """
select customer, cast(generate_subscripts(arr, 1) as bigint) as rank, unnest(arr) as item
from (select customer, string_split(split_part(value, ',', 2), ' ') as arr from rec)""")
def q_parse_ranked_list(spark, sf):
    text = records.format_ranked_list(_topk_records(spark, sf))
    return evaluate.records_to_long(records.parse_ranked_list(text))


# --------------------------------------------------------------------------- evaluation

def _evaluation_inputs(spark, sf):
    t = S.Tables(spark, sf)
    fitted = P.fit_standin(t)
    cands = recommend.all_candidates(P.score_standin(fitted), P.history(fitted))
    ranked = recommend.recommend_topk(cands, K)
    actual = S.actual_purchases(t, P.history(fitted))
    predicted = ranked.select("customer", "rank", F.col("product").alias("item"))
    return predicted, actual.select("customer", F.col("product").alias("item"))


_EVAL = Q.model_ctes() + Q.actual_ctes()


@register("precision_at_rank", _EVAL + """
select customer, rank, item, hit, cast(hits as bigint) as hits,
       case when hit then cast(hits as double) / rank end as precision
from prec""")
def q_precision_at_rank(spark, sf):
    predicted, actual = _evaluation_inputs(spark, sf)
    return evaluate.precision_at_rank(predicted, actual, K)


@register("average_precision", _EVAL + """
select customer, n_actual, round(ap, 9) as ap from ap""")
def q_average_precision(spark, sf):
    predicted, actual = _evaluation_inputs(spark, sf)
    ap = evaluate.average_precision(predicted, actual, K)
    return ap.select("customer", "n_actual", _r9(F.col("ap")).alias("ap"))


@register("average_precision_repeats", _EVAL + """,
bought as (
  select t.customer, p.p_brand as product
  from later_orders t join lineitem l on l.l_orderkey = t.o_orderkey
  join part p on p.p_partkey = l.l_partkey
  where not exists (select 1 from hist h where h.customer = t.customer and h.product = p.p_brand)
),
nrep as (select customer, count(*) as n_actual from bought group by customer)
select n.customer, cast(n.n_actual as bigint) as n_actual,
       round(coalesce(sum(case when p.hit then cast(p.hits as double) / p.rank end), 0.0)
             / least(n.n_actual, 7), 9) as ap
from nrep n left join prec p on p.customer = n.customer group by n.customer, n.n_actual""")
def q_average_precision_repeats(spark, sf):
    """Actual lists with an item for every line bought, as a record file may hold them."""
    t = S.Tables(spark, sf)
    predicted, _ = _evaluation_inputs(spark, sf)
    hist = features.purchase_history(S.basket(t, S.orders_between(t, None, S.TRAIN_CUTOFF)))
    lines = S.purchase_lines(t, S.orders_between(t, S.TRAIN_CUTOFF, S.ACTUAL_END))
    new = lines.join(hist, ["customer", "product"], "left_anti")
    ap = evaluate.average_precision(predicted, new.select("customer", F.col("product").alias("item")),
                                    K, count_repeats=True)
    return ap.select("customer", "n_actual", _r9(F.col("ap")).alias("ap"))


@register("map_at_k", _EVAL + """
select round(avg(ap), 9) as map_at_k, cast(count(*) as bigint) as n_customers from ap""")
def q_map_at_k(spark, sf):
    predicted, actual = _evaluation_inputs(spark, sf)
    m = evaluate.map_at_k(predicted, actual, K)
    return m.select(_r9(F.col("map_at_k")).alias("map_at_k"), "n_customers")


@register("recommend_and_evaluate", _EVAL + """
select (select cast(count(distinct customer) as bigint) from ranked) as n_ranked_customers,
       (select cast(count(*) as bigint) from ranked) as n_recommendations,
       cast(count(*) as bigint) as n_evaluated,
       round(avg(ap), 9) as map_at_k
from ap""")
def q_recommend_and_evaluate(spark, sf):
    return P.recommend_and_evaluate(S.Tables(spark, sf), K).select(
        "n_ranked_customers", "n_recommendations", "n_evaluated",
        _r9(F.col("map_at_k")).alias("map_at_k"))


# --------------------------------------------------------------------------- row snapshots

_SNAPSHOT = Q.model_ctes() + Q.snapshot_ctes()


def _snapshot_model(t: S.Tables) -> bayes.NaiveBayesModel:
    """Fit on wide order rows: their own attributes, the customer id, and brand flags."""
    flags = S.brand_flags(t, S.TRAIN_CUTOFF)
    rows = flags.join(S.order_attributes(t, None, S.TRAIN_CUTOFF).drop("customer"), "o_orderkey")
    rows = rows.withColumnRenamed("customer", S.ID_ATTR)
    return bayes.fit_snapshot(rows, [*S.ORDER_ATTR_COLS, S.ID_ATTR], flags.columns[2:],
                              wide_attrs=(S.ID_ATTR,))


@register("snapshot_likelihood", _SNAPSHOT + """
select attr, value, product, c, round(ll, 9) as ll from slik""")
def q_snapshot_likelihood(spark, sf):
    lik = _snapshot_model(S.Tables(spark, sf)).likelihood
    return lik.select("attr", "value", "product", "c", _r9(F.col("ll")).alias("ll"))


@register("snapshot_score", _SNAPSHOT + "select customer, product, score from sscore")
def q_snapshot_score(spark, sf):
    t = S.Tables(spark, sf)
    rows = S.order_attributes(t, S.TRAIN_CUTOFF, S.ACTUAL_END)
    return bayes.nb_score(_snapshot_model(t), bayes.scoring_facts(rows, S.ORDER_ATTR_COLS, S.ID_ATTR))


def queries() -> dict[str, QueryFn]:
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql}


from nextbest.plans import queries_clean  # noqa: E402,F401  (registers the rest)
