"""Candidate filtering, top-k ranking and ranked-list records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_K = 7


def exclude_owned(scores: DataFrame, history: DataFrame) -> DataFrame:
    """Scored products the customer never owned (anti-join on customer, product)."""
    return scores.join(history.select("customer", "product"), ["customer", "product"],
                       "left_anti")


def _marked(scores: DataFrame, history: DataFrame) -> DataFrame:
    """Scores with ``owned``, ``known`` (has a history) and ``any_novel``.

    One pass on the customer key: the history is a list per customer (at most
    the catalogue), and the window over a customer's scores reuses the same
    partitioning.
    """
    owned = history.groupBy("customer").agg(F.collect_set("product").alias("__owned"))
    marked = scores.join(owned, "customer", "left").withColumns({
        "known": F.col("__owned").isNotNull(),
        "owned": F.coalesce(F.array_contains("__owned", F.col("product")), F.lit(False)),
    }).drop("__owned")
    novel = F.max((~F.col("owned")).cast("int")).over(Window.partitionBy("customer"))
    return marked.withColumn("any_novel", novel == 1)


def new_customers(scores: DataFrame, history: DataFrame) -> DataFrame:
    """Score rows of customers that are not "old".

    Old customers have a purchase history and at least one scored product they
    do not own.  Everyone else (cold-start customers, and customers who own
    every scored product) is new and keeps the whole scored list.
    """
    marked = _marked(scores, history)
    return marked.where(~(F.col("known") & F.col("any_novel"))).select(*scores.columns)


def all_candidates(scores: DataFrame, history: DataFrame,
                   exhausted: str = "recommend_all") -> DataFrame:
    """Novel products, or every scored product for customers with none novel.

    Same rows as ``exclude_owned`` union ``new_customers``, in one pass.
    ``exhausted='drop'`` keeps only novel products.
    """
    if exhausted not in ("recommend_all", "drop"):
        raise ValueError(f"exhausted must be 'recommend_all' or 'drop', not {exhausted!r}")
    if exhausted == "drop":
        return exclude_owned(scores, history)
    marked = _marked(scores, history)
    return marked.where(~F.col("owned") | ~F.col("any_novel")).select(*scores.columns)


def recommend_topk(candidates: DataFrame, k: int | None = DEFAULT_K) -> DataFrame:
    """``(customer, rank, product, score)``, the ``k`` best per customer (None: all, ranked).

    Order: score descending, then product ascending, so ties are deterministic.
    After ``all_candidates`` the rows are already partitioned by customer, so
    ranking needs no shuffle of its own.
    """
    w = Window.partitionBy("customer").orderBy(F.col("score").desc(), F.col("product").asc())
    ranked = candidates.withColumn("rank", F.row_number().over(w).cast("bigint"))
    if k is not None:
        ranked = ranked.where(F.col("rank") <= k)
    return ranked.select("customer", "rank", "product", "score")


def collect_predictions(ranked: DataFrame, items: str = "items") -> DataFrame:
    """``(customer, items)``: products in rank order.

    The group per customer is at most the catalogue (or ``k`` after top-k).
    """
    ordered = F.array_sort(F.collect_list(F.struct("rank", "product")))
    return ranked.groupBy("customer").agg(
        F.transform(ordered, lambda s: s["product"]).alias(items))


def truncate_list(records: DataFrame, k: int = DEFAULT_K, items: str = "items") -> DataFrame:
    """Keep the first ``k`` entries of each list."""
    return records.withColumn(items, F.slice(items, 1, k))


def sort_records(records: DataFrame, id_col: str = "customer") -> DataFrame:
    """Order records by numeric id.

    A global ``orderBy`` is range-partitioned: every task sorts one id range,
    so the sort scales out instead of funnelling into one partition.
    """
    return records.orderBy(F.col(id_col).cast("bigint").asc())
