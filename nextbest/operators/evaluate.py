"""Average precision at k and its mean, in long form.

``predicted`` is ``(customer, rank, item)`` with 1-based positions, ``actual``
is ``(customer, item)``.  For customer ``u``:

    AP@k(u) = sum over positions i <= k whose item is relevant and appears
              there for the first time of hits(i) / i, divided by
              min(|actual(u)|, k); 0 when actual(u) is empty.

Customers are paired by id (not by line position), and every customer of the
evaluated population counts in the mean, including ones with no actual items
or no prediction.  Every group is a customer's list: at most ``k`` predicted
rows, at most the catalogue of actual rows.  The metric meets the two lists of a
customer in one row and folds over them; ``precision_at_rank`` gives the single
steps as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_K = 7


def precision_at_rank(predicted: DataFrame, actual: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """``(customer, rank, item, hit, hits, precision)`` for the first ``k`` positions.

    ``hit`` is a relevant item at its first position; ``hits`` is the running
    number of hits; ``precision = hits / rank`` on hit rows, else null.
    """
    rel = actual.select("customer", "item").distinct().withColumn("relevant", F.lit(True))
    top = predicted.select("customer", "rank", "item").where(F.col("rank") <= k)
    first = F.row_number().over(Window.partitionBy("customer", "item").orderBy("rank")) == 1
    marked = (top.join(rel, ["customer", "item"], "left")
              .withColumn("hit", F.coalesce(F.col("relevant"), F.lit(False)) & first))
    running = Window.partitionBy("customer").orderBy("rank").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    hits = F.sum(F.col("hit").cast("bigint")).over(running)
    return (marked.withColumn("hits", hits)
            .withColumn("precision", F.when(F.col("hit"), F.col("hits") / F.col("rank")))
            .select("customer", "rank", "item", "hit", "hits", "precision"))


def average_precision(predicted: DataFrame, actual: DataFrame, k: int = DEFAULT_K,
                      population: DataFrame | None = None, count_repeats: bool = False
                      ) -> DataFrame:
    """``(customer, n_actual, ap)`` for every customer of ``population``.

    ``n_actual`` counts distinct items; with ``count_repeats`` it is the length
    of the actual list, repeats included (a hit still counts an item once).

    ``population`` defaults to the customers present in ``actual``; give the
    id column of actual records to count customers with an empty actual list.
    """
    listed = actual.select("customer", "item")
    n_act = F.count(F.lit(1)) if count_repeats else F.size(F.collect_set(F.struct("item")))
    bought = listed.groupBy("customer").agg(F.collect_set("item").alias("__actual"),
                                            n_act.alias("n_actual"))
    top = predicted.where(F.col("rank") <= k).groupBy("customer").agg(
        F.array_sort(F.collect_list(F.struct("rank", "item"))).alias("__top"))
    rows = bought
    if population is not None:
        rows = population.select("customer").distinct().join(bought, "customer", "left")
    n = F.coalesce("n_actual", F.lit(0))
    return rows.join(top, "customer", "left").select(
        "customer", n.cast("bigint").alias("n_actual"),
        F.when(n == 0, F.lit(0.0)).otherwise(
            F.coalesce(precision_sum("__top", "__actual"), F.lit(0.0)) / F.least(n, F.lit(k)))
        .alias("ap"))


def precision_sum(top: str, actual: str) -> Column:
    """Sum of hits(i) / i over the hits of a list of ``(rank, item)`` in rank order.

    A hit is an item of ``actual`` at its first place in the list; the fold runs
    inside the row, over at most k entries.
    """
    hits = F.filter(top, lambda x, i: F.array_contains(actual, x["item"]) & ~F.exists(
        F.slice(top, F.lit(1), i), lambda y: y["item"] == x["item"]))
    terms = F.transform(hits, lambda x, i: (i + 1) / x["rank"])
    return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)


def map_at_k(predicted: DataFrame, actual: DataFrame, k: int = DEFAULT_K,
             population: DataFrame | None = None, count_repeats: bool = False) -> DataFrame:
    """One row ``(map_at_k, n_customers)``."""
    ap = average_precision(predicted, actual, k, population, count_repeats)
    return ap.agg(F.avg("ap").alias("map_at_k"),
                  F.count(F.lit(1)).cast("bigint").alias("n_customers"))


def records_to_long(records: DataFrame, id_col: str = "customer",
                    items: str = "items") -> DataFrame:
    """``(customer, rank, item)`` from ``(id, items array)`` records; blanks dropped."""
    return (records.select(F.col(id_col).alias("customer"),
                           F.posexplode(F.array_remove(items, "")).alias("pos", "item"))
            .select("customer", (F.col("pos") + 1).cast("bigint").alias("rank"), "item"))


def map_at_k_records(actual: DataFrame, predicted: DataFrame, k: int = DEFAULT_K,
                     id_col: str = "customer", items: str = "items") -> DataFrame:
    """MAP@k of two ranked-list record sets joined on id; population = actual ids."""
    act = records_to_long(actual, id_col, items)
    pred = records_to_long(predicted, id_col, items)
    pop = actual.select(F.col(id_col).alias("customer"))
    return map_at_k(pred, act.select("customer", "item"), k, pop, count_repeats=True)


def average_precision_records(actual: DataFrame, predicted: DataFrame, k: int = DEFAULT_K,
                              id_col: str = "customer", items: str = "items") -> DataFrame:
    act = records_to_long(actual, id_col, items)
    pred = records_to_long(predicted, id_col, items)
    pop = actual.select(F.col(id_col).alias("customer"))
    return average_precision(pred, act.select("customer", "item"), k, pop, count_repeats=True)
