"""Composed jobs: fit on the training window, score, filter, rank, evaluate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from pyspark.sql import functions as F

from nextbest.operators import bayes, clean, encode, evaluate, features, recommend
from nextbest.plans import standins as S
from nextbest.sources import records


@dataclass
class Fitted:
    model: bayes.NaiveBayesModel
    counts: DataFrame        # (customer, product, n); its keys are the history
    attributes: DataFrame    # (customer, attr columns...)
    instances: DataFrame     # training orders


def fit_standin(t: S.Tables, cutoff: str = S.TRAIN_CUTOFF) -> Fitted:
    orders = S.orders_between(t, None, cutoff)
    facts = S.basket(t, orders)
    attrs = S.customer_attributes(t)
    model, counts = bayes.fit_basket(orders, facts, attrs, S.ATTR_COLS, S.ID_ATTR,
                                     products=S.brand_catalogue(t))
    return Fitted(model, counts, attrs, orders)


def score_standin(fitted: Fitted) -> DataFrame:
    """``(customer, product, score)`` for every customer of the scoring set."""
    facts = bayes.scoring_facts(fitted.attributes, S.ATTR_COLS, S.ID_ATTR)
    return bayes.nb_score(fitted.model, facts)


def history(fitted: Fitted) -> DataFrame:
    return fitted.counts.select("customer", "product")


def recommend_standin(t: S.Tables, cutoff: str = S.TRAIN_CUTOFF, k: int = recommend.DEFAULT_K,
                      exhausted: str = "recommend_all") -> DataFrame:
    """Flagship: top-k novel brands per customer, ``(customer, rank, product, score)``."""
    fitted = fit_standin(t, cutoff)
    cands = recommend.all_candidates(score_standin(fitted), history(fitted), exhausted)
    return recommend.recommend_topk(cands, k)


def recommend_and_evaluate(t: S.Tables, k: int = recommend.DEFAULT_K,
                           cutoff: str = S.TRAIN_CUTOFF, actual_end: str = S.ACTUAL_END
                           ) -> DataFrame:
    """Fit before ``cutoff``, rank top-k, score against purchases in ``[cutoff, actual_end)``.

    One row: ranked customers, recommendations, evaluated customers, MAP@k.
    """
    fitted = fit_standin(t, cutoff)
    hist = history(fitted)
    ranked = recommend.recommend_topk(
        recommend.all_candidates(score_standin(fitted), hist), k)
    actual = S.actual_purchases(t, hist, cutoff, actual_end)
    # one row per customer with both lists: counts and metric come from one pass
    listed = ranked.groupBy("customer").agg(F.array_sort(F.collect_list(
        F.struct("rank", F.col("product").alias("item")))).alias("top"))
    bought = actual.groupBy("customer").agg(F.collect_set("product").alias("bought"))
    n = F.size("bought")
    ap = F.when(F.col("bought").isNotNull(), F.coalesce(
        evaluate.precision_sum("top", "bought"), F.lit(0.0)) / F.least(n, F.lit(k)))
    return listed.join(bought, "customer", "full").agg(
        F.count("top").alias("n_ranked_customers"),
        F.coalesce(F.sum(F.size("top")), F.lit(0)).cast("bigint").alias("n_recommendations"),
        F.count("bought").alias("n_evaluated"), F.avg(ap).alias("map_at_k"))


@dataclass
class SnapshotRun:
    """What ``recommend_from_files`` wrote and computed."""

    train: DataFrame          # cleaned and encoded, read back
    test: DataFrame
    recommendations: DataFrame  # ranked lists, read back
    metric: DataFrame         # (map_at_k, n_customers)


def recommend_from_files(spark, train_csv: str, test_csv: str, folder: str,
                         cols: clean.SnapshotColumns | None = None, k: int = recommend.DEFAULT_K,
                         province_fixes: dict | None = None) -> SnapshotRun:
    """The whole job from two CSV snapshots to ranked-list files and their MAP@k.

    Scan, clean each split, fit the category codes on the training split and
    apply them to both, write both tables, fit on the flags of the training
    rows, score the test customers, rank what they don't own, write sorted
    ranked lists, read them back and compare with what the test rows own anew.
    ``folder`` must be one that all executors share.
    """
    c = cols or clean.SnapshotColumns()
    cleaned = {name: clean.clean_snapshot(records.read_snapshot_csv(spark, path), c,
                                          drop_late=False, province_fixes=province_fixes)
               for name, path in (("train", train_csv), ("test", test_csv))}
    coded = [x for x in c.categorical if x in cleaned["train"].columns]
    codes = encode.category_dictionary(cleaned["train"], coded, [c.snapshot_date, c.customer])
    codes = codes.checkpoint()
    for name, df in cleaned.items():
        table = encode.encode_categories(df, codes, coded, unseen_code=0).drop(*c.dropped_late)
        records.write_table(table, f"{folder}/{name}")
    train, test = (spark.read.parquet(f"{folder}/{name}") for name in ("train", "test"))

    products = clean.select_by_regex(train, c.product_pattern).columns
    attrs = [x for x in train.columns if x not in products and x != c.customer]
    model = bayes.fit_snapshot(train, [*attrs, c.customer], products, wide_attrs=(c.customer,))
    scores = bayes.nb_score(model, bayes.scoring_facts(test, attrs, c.customer, c.customer))
    owned = features.purchase_long(train, [c.customer], products)
    hist = owned.select(F.col(c.customer).alias("customer"), "product").distinct()
    ranked = recommend.recommend_topk(recommend.all_candidates(scores, hist), k)
    records.write_ranked_list(recommend.collect_predictions(ranked), f"{folder}/recommendations")

    bought = features.purchase_long(test, [c.customer], products).select(
        F.col(c.customer).alias("customer"), "product").distinct()
    new = bought.join(hist, ["customer", "product"], "left_anti")
    records.write_ranked_list(features.purchase_lists(new), f"{folder}/actual")
    predicted = records.read_ranked_list(spark, f"{folder}/recommendations")
    actual = records.read_ranked_list(spark, f"{folder}/actual")
    return SnapshotRun(train, test, predicted, evaluate.map_at_k_records(actual, predicted, k))


def standin_from_files(t: S.Tables, folder: str, k: int = recommend.DEFAULT_K,
                       province_fixes: dict | None = None) -> DataFrame:
    """``recommend_from_files`` over the raw-snapshot stand-in; one row of counts and MAP@k."""
    raw = S.raw_snapshot(t)
    splits = {"train": F.col("fecha_dato") < S.TRAIN_CUTOFF,
              "test": F.col("fecha_dato").between(S.TRAIN_CUTOFF, S.ACTUAL_LAST)}
    for name, rows in splits.items():
        records.write_table(raw.where(rows), f"{folder}/{name}_csv", "csv")
    run = recommend_from_files(t.spark, f"{folder}/train_csv", f"{folder}/test_csv", folder, k=k,
                               province_fixes=province_fixes)
    lists = run.recommendations.agg(F.count(F.lit(1)).alias("c"), F.sum(F.size("items")).alias("r"))
    return run.metric.select(
        F.lit(run.train.count()).cast("bigint").alias("n_train"),
        F.lit(run.test.count()).cast("bigint").alias("n_test"),
        lists.select("c").scalar().cast("bigint").alias("n_ranked_customers"),
        lists.select("r").scalar().cast("bigint").alias("n_recommendations"),
        F.col("n_customers").alias("n_evaluated"), "map_at_k")
