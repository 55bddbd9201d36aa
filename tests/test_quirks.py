"""Hand-built micro-tables, one per behaviour decided in the survey's quirk ledger."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from nextbest.operators import bayes, clean, encode, evaluate, recommend
from nextbest.operators.ranking import lower_median


def _fit(spark, owned, attrs, instances=None):
    """owned: [(instance, customer, product)]; attrs: [(customer, a)]."""
    basket = spark.createDataFrame(owned, "instance long, customer long, product string")
    inst = spark.createDataFrame(instances or sorted({(i, c) for i, c, _ in owned}),
                                 "instance long, customer long")
    at = spark.createDataFrame(attrs, "customer long, a string")
    model, counts = bayes.fit_basket(inst, basket, at, ["a"])
    return model, counts


def _scores(spark, model, scoring):
    sc = spark.createDataFrame(scoring, "customer long, a string")
    facts = bayes.scoring_facts(sc, ["a"])
    return {(r.customer, r.product): r.score for r in bayes.nb_score(model, facts).collect()}


def test_unseen_value_adds_nothing_and_unmatched_product_is_absent(spark):
    # three training instances; instance 3 owns nothing but counts in N
    model, _ = _fit(spark, [(1, 1, "p1"), (2, 2, "p2")], [(1, "x"), (2, "y"), (3, "x")],
                    instances=[(1, 1), (2, 2), (3, 3)])
    s = _scores(spark, model, [(9, "x"), (8, "z")])
    assert set(s) == {(9, "p1")}
    assert s[(9, "p1")] == pytest.approx(math.log(2 / 2) + math.log(1 / 3), abs=1e-9)


def test_repeated_scoring_row_doubles_likelihood_prior_once(spark):
    model, _ = _fit(spark, [(1, 1, "p1"), (2, 2, "p1"), (3, 3, "p2")],
                    [(1, "x"), (2, "y"), (3, "x")])
    once = _scores(spark, model, [(9, "x")])
    twice = _scores(spark, model, [(9, "x"), (9, "x")])
    ll = math.log((1 + 1) / (2 + 1))
    prior = math.log(2 / 3)
    assert once[(9, "p1")] == pytest.approx(ll + prior, abs=1e-9)
    assert twice[(9, "p1")] == pytest.approx(2 * ll + prior, abs=1e-9)


def test_exhausted_customer_gets_all_or_none(spark):
    scores = spark.createDataFrame([(1, "a", -1.0), (1, "b", -2.0), (2, "a", -1.0)],
                                   "customer long, product string, score double")
    hist = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b")],
                                 "customer long, product string")
    everything = recommend.all_candidates(scores, hist).collect()
    assert sorted((r.customer, r.product) for r in everything) == [(1, "a"), (1, "b"), (2, "a")]
    dropped = recommend.all_candidates(scores, hist, exhausted="drop").collect()
    assert sorted((r.customer, r.product) for r in dropped) == [(2, "a")]
    new = recommend.new_customers(scores, hist).collect()
    assert sorted((r.customer, r.product) for r in new) == [(1, "a"), (1, "b")]


def test_ties_break_on_product_name(spark):
    c = spark.createDataFrame([(1, "zeta", -1.0), (1, "alpha", -1.0), (1, "mid", -0.5)],
                              "customer long, product string, score double")
    got = [(r["rank"], r.product) for r in recommend.recommend_topk(c, 2).orderBy("rank").collect()]
    assert got == [(1, "mid"), (2, "alpha")]


def test_codes_are_fit_on_train_and_shared(spark):
    train = spark.createDataFrame([("2015-01-28", 1, "B"), ("2015-01-28", 2, "A"),
                                   ("2015-02-28", 3, "B"), ("2015-01-27", 4, "C")],
                                  "d string, id long, v string")
    test = spark.createDataFrame([("2015-03-28", 5, "A"), ("2015-03-28", 6, "Z")],
                                 "d string, id long, v string")
    d = encode.category_dictionary(train, ["v"], ["d", "id"])
    codes = {r.value: r.code for r in d.collect()}
    assert codes == {"C": 1, "B": 2, "A": 3}
    enc = {r.id: r.v for r in encode.encode_categories(test, d, ["v"], unseen_code=0).collect()}
    assert enc == {5: 3, 6: 0}
    enc_null = {r.id: r.v for r in encode.encode_categories(test, d, ["v"]).collect()}
    assert enc_null == {5: 3, 6: None}


def test_age_bands_fill_in_order(spark):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(["10", "20", "30", "50", "120", None])],
                               "id long, age string")
    got = [r.age for r in clean.age_normalize(df, "age").orderBy("id").collect()]
    # <18 -> mean(20, 30) = 25; >100 -> mean(30, 50) = 40; null -> mean(25,20,30,50,40) = 33
    assert got == [25, 20, 30, 50, 40, 33]


def test_seniority_min_before_clamp(spark):
    df = spark.createDataFrame([(1, " -3"), (2, "5"), (3, "NA")], "id long, s string")
    got = [r.s for r in clean.seniority_fill(df, "s").orderBy("id").collect()]
    assert got == [0, 5, 0]


def test_even_length_median_date(spark):
    days = [dt.date(2015, 1, d) for d in (4, 1, 3, 2)] + [None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id long, d date")
    lower = lower_median(df, "d").first()["median"]
    counted = lower_median(df, "d", nulls_counted=True).first()["median"]
    assert lower == dt.date(2015, 1, 2)
    assert counted == dt.date(2015, 1, 3)
    filled = clean.median_date_fill(df, "d").where("id = 4").first().d
    assert filled == dt.date(2015, 1, 2)


def test_repeated_prediction_counts_once_and_empty_actual_counts(spark):
    pred = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["a"])], "customer long, items array<string>")
    act = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "customer long, items array<string>")
    ap = {r.customer: r.ap for r in evaluate.average_precision_records(act, pred, 7).collect()}
    assert ap[1] == pytest.approx((1 / 1 + 2 / 3) / 2)
    assert ap[2] == 0.0
    m = evaluate.map_at_k_records(act, pred, 7).first()
    assert m.n_customers == 2
    assert m.map_at_k == pytest.approx((1 + 2 / 3) / 4)


def test_group_median_fill_falls_back_to_overall(spark):
    df = spark.createDataFrame([(1, "A", 1.0), (2, "A", 3.0), (3, "A", None), (4, "B", None),
                                (5, "C", 10.0)], "id long, g string, v double")
    got = {r.id: r.v for r in clean.group_median_fill(df, "v", "g").collect()}
    assert got == {1: 1.0, 2: 3.0, 3: 2.0, 4: 3.0, 5: 10.0}


def test_null_profile_and_unknown_fill(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "id long, e string, f string")
    prof = clean.null_profile(df).first().asDict()
    assert prof == {"id": False, "e": True, "f": True}
    filled = clean.unknown_fill(df).orderBy("id").collect()
    assert [(r.e, r.f) for r in filled] == [("UNKNOWN", "x"), ("UNKNOWN", "UNKNOWN")]


def test_code_map_passes_unknown_values_through(spark):
    df = spark.createDataFrame([(1, "1.0"), (2, "3"), (3, None), (4, "Q")], "id long, r string")
    got = {r.id: r.r for r in clean.code_map(df, "r", clean.CUSTOMER_TYPE_CODES, "P").collect()}
    assert got == {1: "1", 2: "3", 3: "P", 4: "Q"}


def test_posterior_is_exp_of_score(spark):
    s = spark.createDataFrame([(1, "a", -2.0)], "customer long, product string, score double")
    assert bayes.posterior_prob(s).first().posterior == pytest.approx(math.exp(-2.0))


def test_salted_join_matches_plain_join_on_a_hot_key(spark):
    from nextbest.operators.joins import salted_join
    big = spark.range(5000).select(F.col("id").alias("customer"),
                                   F.when(F.col("id") % 3 == 0, "hot").otherwise(
                                       (F.col("id") % 7).cast("string")).alias("k"))
    small = spark.createDataFrame([("hot", 1.0), ("1", 2.0), ("2", 3.0)], "k string, w double")
    a = sorted(tuple(r) for r in big.join(small, ["k"]).collect())
    b = sorted(tuple(r) for r in salted_join(big, small, ["k"], salts=8,
                                              salt_by=["customer"]).collect())
    assert a == b


def test_repeated_scoring_row_on_shuffled_paths(spark):
    # id attribute (wide, shuffled) and narrow attribute forced past the broadcast limit
    basket = spark.createDataFrame([(1, 1, "p1"), (2, 2, "p1"), (3, 1, "p2")],
                                   "instance long, customer long, product string")
    inst = spark.createDataFrame([(1, 1), (2, 2), (3, 1)], "instance long, customer long")
    at = spark.createDataFrame([(1, "x"), (2, "y")], "customer long, a string")
    model, _ = bayes.fit_basket(inst, basket, at, ["a"], id_attr="cid")
    sc = spark.createDataFrame([(1, "x"), (1, "x")], "customer long, a string")
    facts = bayes.scoring_facts(sc, ["a"], "cid")
    fast = {(r.customer, r.product): r.score for r in bayes.nb_score(model, facts).collect()}
    slow = {(r.customer, r.product): r.score
            for r in bayes.nb_score(model, facts, max_bytes=0, salts=3).collect()}
    assert fast == slow
    # p1: attr x seen once with p1 (f=2), id 1 owns p1 once; both counted twice, prior once
    ll = 2 * math.log(2 / 3) + 2 * math.log(2 / 3)
    assert fast[(1, "p1")] == pytest.approx(ll + math.log(2 / 3), abs=1e-9)
