"""Reference concepts mapped onto the driver's test tables.

* training instance   one order before the cut-off (``o_orderkey``)
* product owned       a brand (``p_brand``) on one of the order's line items
* customer attributes ``c_nationkey``, ``c_mktsegment``, the balance band
                      ``floor(c_acctbal / 1000)``, and the customer id itself
* scoring set         every row of ``customer``
* actual purchases    brands first bought in the year after the cut-off
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nextbest.operators.joins import split_join
from nextbest.sources.tables import read_table

# Fixed parameters of the time split.
TRAIN_CUTOFF = "1996-01-01"
ACTUAL_END = "1997-01-01"
ACTUAL_LAST = "1996-12-31"
LATE_CUTOFF = "2001-01-01"   # leaves customers who own every brand (exhausted case)
ATTR_COLS = ["c_nationkey", "c_mktsegment", "acctbal_band"]
ID_ATTR = "c_custkey"


@dataclass
class Tables:
    spark: SparkSession
    sf_dir: str

    def read(self, name: str, columns: list[str] | None = None) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, columns)


def orders_between(t: Tables, start: str | None, end: str | None) -> DataFrame:
    """``(o_orderkey, customer)`` of orders with ``start <= o_orderdate < end``."""
    o = t.read("orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    if start:
        o = o.where(F.col("o_orderdate") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        o = o.where(F.col("o_orderdate") < F.lit(end).cast("timestamp_ntz"))
    return o.select("o_orderkey", F.col("o_custkey").alias("customer"))


#: Lines of orders that one task joins and aggregates.
TASK_LINES = 500_000


def _by_order(t: Tables, lines: DataFrame) -> DataFrame:
    """``lines`` dealt out by order key, over as many tasks as the number of lines asks for.

    Counting a parquet table reads its footers only.  A number that is given
    stays as it is: AQE would merge partitions until there are few tasks, each
    with a share of the table.
    """
    tasks = -(-t.read("lineitem").count() // TASK_LINES)
    return lines.repartition(max(tasks, t.spark.sparkContext.defaultParallelism), "l_orderkey")


def purchase_lines(t: Tables, orders: DataFrame) -> DataFrame:
    """``(o_orderkey, customer, product)``, one row per line item, repeats included.

    Lines meet their part first and are then dealt out by order, so that the join
    with the orders and what is grouped by order after it need no further shuffle
    of the lines.  Join strategy is left to Catalyst and AQE (the date filter is
    pushed into the orders scan; only key columns are read from lineitem).
    """
    li = t.read("lineitem", ["l_orderkey", "l_partkey"])
    part = t.read("part", ["p_partkey", "p_brand"])
    lines = li.join(part, li.l_partkey == part.p_partkey).select("l_orderkey", "p_brand")
    return (orders.join(_by_order(t, lines), F.col("o_orderkey") == F.col("l_orderkey"))
            .select("o_orderkey", "customer", F.col("p_brand").alias("product")))


def basket(t: Tables, orders: DataFrame) -> DataFrame:
    """Distinct ``(o_orderkey, customer, product)``: brands on each order."""
    return purchase_lines(t, orders).distinct()


def order_attributes(t: Tables, start: str | None, end: str | None) -> DataFrame:
    """``(o_orderkey, customer, o_orderpriority, o_orderstatus)``: attributes of single orders."""
    o = t.read("orders", ["o_orderkey", "o_orderpriority", "o_orderstatus"])
    return orders_between(t, start, end).join(o, "o_orderkey")


ORDER_ATTR_COLS = ["o_orderpriority", "o_orderstatus"]


def customer_attributes(t: Tables) -> DataFrame:
    """``(customer, c_nationkey, c_mktsegment, acctbal_band)``, one row per customer."""
    c = t.read("customer", ["c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"])
    return c.select(F.col("c_custkey").alias("customer"), "c_nationkey", "c_mktsegment",
                    F.floor(F.col("c_acctbal") / 1000).cast("bigint").alias("acctbal_band"))


def actual_purchases(t: Tables, history: DataFrame, start: str = TRAIN_CUTOFF,
                     end: str = ACTUAL_END) -> DataFrame:
    """``(customer, product)``: brands bought in ``[start, end)`` and never before."""
    later = basket(t, orders_between(t, start, end)).select("customer", "product").distinct()
    return later.join(history.select("customer", "product"), ["customer", "product"],
                      "left_anti")


# --------------------------------------------------------------------------- snapshot stand-ins

def brand_catalogue(t: Tables) -> list[str]:
    """Product catalogue of the test tables: the brands of ``part``, in order.

    A catalogue becomes columns, so its size is that of a schema.
    """
    rows = t.read("part", ["p_brand"]).where("p_brand is not null").distinct().collect()
    return sorted(r["p_brand"] for r in rows)


#: Products whose flags share one number.
_MASK_BITS = 63


def brand_flags(t: Tables, cutoff: str | None = TRAIN_CUTOFF) -> DataFrame:
    """Wide snapshot: one row per order (before ``cutoff``, None: all), one 0/1 column per brand.

    Orders without line items keep a row of zeros (they still count as instances).
    An order's brands are the bits of one number (per 63 brands) until the last
    projection, so no shuffle, sort or aggregate holds a column per brand.
    """
    orders, brands = orders_between(t, None, cutoff), brand_catalogue(t)
    masks = [f"__m{w}" for w in range(-(-len(brands) // _MASK_BITS))]
    place = F.array_position(F.lit(brands), F.col("p_brand")).cast("int") - 1
    part = t.read("part", ["p_partkey", "p_brand"]).where("p_brand is not null").select(
        "p_partkey", place.alias("__place")).select("p_partkey", *[
            F.when(F.floor(F.col("__place") / _MASK_BITS) == w, F.call_function(
                "shiftleft", F.lit(1).cast("bigint"), F.col("__place") - w * _MASK_BITS)).alias(m)
            for w, m in enumerate(masks)])
    li = t.read("lineitem", ["l_orderkey", "l_partkey"])
    # dealt out first: an order's lines may be far apart, then map tasks would hold all keys
    lines = li.join(part, li.l_partkey == part.p_partkey).select("l_orderkey", *masks)
    owned = _by_order(t, lines).groupBy("l_orderkey").agg(
        *[F.bit_or(m).alias(m) for m in masks])
    # an order key that several customers share counts once for each of them
    holder = F.when(F.col("l_orderkey").isNotNull(), F.struct("customer"))
    out = orders.join(owned, orders.o_orderkey == owned.l_orderkey, "left").withColumn(
        "__holders", F.size(F.collect_set(holder).over(Window.partitionBy("o_orderkey"))))
    flag = [F.getbit(masks[k // _MASK_BITS], F.lit(k % _MASK_BITS)) for k in range(len(brands))]
    return out.select("o_orderkey", "customer", *[
        F.coalesce(f * F.col("__holders"), F.lit(0)).cast("int").alias(b)
        for f, b in zip(flag, brands)])


# Fixed values of the stand-in: relation-month text per order priority.
PRIORITY_RELATION_TEXT = {"1-URGENT": "1.0", "2-HIGH": "1", "3-MEDIUM": "3.0",
                          "4-NOT SPECIFIED": "P"}


def raw_snapshot(t: Tables) -> DataFrame:
    """Raw-snapshot stand-in, one row per order (all orders), as untyped text.

    Values come from the order, its customer and nation; nulls, NA tokens,
    junk-padded numbers and variant codes are derived from the order's
    priority and status so both engines make the same ones.
    """
    o = t.read("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                          "o_orderdate", "o_orderpriority"])
    c = t.read("customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    n = t.read("nation", ["n_nationkey", "n_name"])
    # a customer may hold a third of all orders
    j = split_join(o, c.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"]).join(
        n, F.col("c_nationkey") == n.n_nationkey)
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")

    def unless(p: str, s: str, value):
        return F.when(~((pr == p) & (st == s)), value)

    day = F.to_date("o_orderdate")
    age = F.concat(F.lit(" "), F.floor(F.col("o_totalprice") / 4000).cast("bigint").cast("string"))
    seniority = F.floor(F.datediff(day, F.lit("1996-01-01").cast("date")) / 30).cast("bigint")
    rel_text = F.lit(None).cast("string")
    for k, v in PRIORITY_RELATION_TEXT.items():
        rel_text = F.when(pr == k, F.lit(v)).otherwise(rel_text)
    return j.select(
        F.date_format(day, "yyyy-MM-dd").alias("fecha_dato"),
        F.col("o_custkey").alias("ncodpers"),
        F.when((pr == "5-LOW") & (st == "P"), F.lit("         NA")).otherwise(age).alias("age"),
        unless("1-URGENT", "F", F.date_format(
            F.date_sub(day, F.pmod(F.floor("o_totalprice"), F.lit(3000)).cast("int")),
            "yyyy-MM-dd")).alias("fecha_alta"),
        unless("2-HIGH", "F", F.when(st == "O", 1).otherwise(0)).alias("ind_nuevo"),
        F.when((pr == "3-MEDIUM") & (st == "P"), F.lit("NA"))
        .otherwise(F.concat(F.lit("  "), seniority.cast("string"))).alias("antiguedad"),
        unless("4-NOT SPECIFIED", "O", F.when(st == "P", 99).otherwise(1)).alias("indrel"),
        F.when((pr == "1-URGENT") & (st == "P"), F.date_format(day, "yyyy-MM-dd"))
        .alias("ult_fec_cli_1t"),
        rel_text.alias("indrel_1mes"),
        F.when(st == "O", "A").when(st == "F", "I").alias("tiprel_1mes"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "V").otherwise("H")
        .alias("sexo"),
        F.lit(None).cast("string").alias("conyuemp"),
        F.when(F.col("c_acctbal") <= 9000,
               F.concat(F.lit("K"), F.substring("c_mktsegment", 1, 2))).alias("canal_entrada"),
        unless("2-HIGH", "P", F.lit("N")).alias("indfall"),
        F.lit(1).alias("tipodom"),
        F.col("c_nationkey").alias("cod_prov"),
        F.when(~((F.col("c_mktsegment") == "AUTOMOBILE") & (st == "P")), F.col("n_name"))
        .alias("nomprov"),
        unless("5-LOW", "F", F.when(st == "O", 1).otherwise(0)).alias("ind_actividad_cliente"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("renta"),
        F.col("c_mktsegment").alias("segmento"),
        F.when(pr.isin("1-URGENT", "2-HIGH"), 1).otherwise(0).alias("ind_cco_fin_ult1"),
        unless("3-MEDIUM", "F", F.when(F.col("o_totalprice") > 250000, 1).otherwise(0))
        .alias("ind_nomina_ult1"),
        unless("4-NOT SPECIFIED", "P", F.when(st == "F", 1).otherwise(0))
        .alias("ind_nom_pens_ult1"),
    )
