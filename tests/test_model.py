"""Wide (snapshot) and long (basket) fits agree; recommendation invariants hold."""

from pyspark.sql import functions as F

from nextbest.operators import bayes, recommend
from nextbest.plans import pipeline as P
from nextbest.plans import standins as S

from conftest import SF_SMALL


def _rows(df, cols, r=9):
    return sorted(tuple(round(x, r) if isinstance(x, float) else x for x in row)
                  for row in df.select(*cols).collect())


def test_wide_and_long_fit_agree(spark):
    t = S.Tables(spark, SF_SMALL)
    fitted = P.fit_standin(t)
    flags = S.brand_flags(t)
    attrs = S.customer_attributes(t)
    wide = (flags.join(attrs, "customer")
            .withColumn(S.ID_ATTR, F.col("customer")))
    model = bayes.fit_snapshot(wide, S.ATTR_COLS + [S.ID_ATTR], S.brand_catalogue(t),
                               wide_attrs=(S.ID_ATTR,))
    assert _rows(model.prior, ["product", "f", "n", "log_prior"]) == \
        _rows(fitted.model.prior, ["product", "f", "n", "log_prior"])
    assert _rows(model.likelihood, ["attr", "value", "product", "c", "ll"]) == \
        _rows(fitted.model.likelihood, ["attr", "value", "product", "c", "ll"])
    facts = bayes.scoring_facts(attrs, S.ATTR_COLS, S.ID_ATTR)
    assert _rows(bayes.nb_score(model, facts), ["customer", "product", "score"]) == \
        _rows(bayes.nb_score(fitted.model, facts), ["customer", "product", "score"])


def test_recommendation_invariants(spark):
    t = S.Tables(spark, SF_SMALL)
    fitted = P.fit_standin(t)
    hist = P.history(fitted)
    scores = P.score_standin(fitted)
    top = recommend.recommend_topk(recommend.all_candidates(scores, hist), 7)
    per = top.groupBy("customer").agg(F.count("*").alias("n"), F.max("rank").alias("mx"),
                                      F.countDistinct("product").alias("d")).collect()
    assert all(r.n <= 7 and r.mx == r.n and r.d == r.n for r in per)
    novel_customers = recommend.exclude_owned(scores, hist).select("customer").distinct()
    owned_hits = (top.join(hist, ["customer", "product"])
                  .join(novel_customers, "customer", "left_semi"))
    assert owned_hits.count() == 0


def test_broadcast_fallback_gives_same_scores(spark):
    t = S.Tables(spark, SF_SMALL)
    fitted = P.fit_standin(t)
    facts = bayes.scoring_facts(fitted.attributes, S.ATTR_COLS, S.ID_ATTR)
    a = _rows(bayes.nb_score(fitted.model, facts), ["customer", "product", "score"])
    b = _rows(bayes.nb_score(fitted.model, facts, max_bytes=0, salts=4),
              ["customer", "product", "score"])
    assert a == b


def test_partition_count_does_not_change_results(spark):
    t = S.Tables(spark, SF_SMALL)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = _rows(P.recommend_standin(t), ["customer", "rank", "product", "score"])
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        b = _rows(P.recommend_standin(t), ["customer", "rank", "product", "score"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b


def test_relabelling_categories_keeps_ranks(spark):
    from nextbest.operators import encode
    t = S.Tables(spark, SF_SMALL)
    orders = S.orders_between(t, None, S.TRAIN_CUTOFF)
    facts = S.basket(t, orders)
    attrs = S.customer_attributes(t)
    d = encode.category_dictionary(attrs, ["c_mktsegment"], ["customer"])
    coded = encode.encode_categories(attrs, d, ["c_mktsegment"])

    def ranked(a):
        model, counts = bayes.fit_basket(orders, facts, a, S.ATTR_COLS, S.ID_ATTR)
        sc = bayes.nb_score(model, bayes.scoring_facts(a, S.ATTR_COLS, S.ID_ATTR))
        hist = counts.select("customer", "product")
        return _rows(recommend.recommend_topk(recommend.all_candidates(sc, hist), 7),
                     ["customer", "rank", "product", "score"])

    assert ranked(attrs) == ranked(coded)
