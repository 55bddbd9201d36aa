"""Categorical naive Bayes over purchase facts, as grouped counts and joins.

Model (one training instance = one customer snapshot / one order):

* ``N``          number of training instances
* ``f(p)``       instances that own product ``p``
* ``prior(p)``   ``f(p) / N`` (products are multi-label, priors need not sum to 1)
* ``c(a,v,p)``   instances with attribute ``a`` equal to ``v`` that own ``p``
* ``ll(a,v,p)``  ``ln((c + 1) / (f + 1))``, defined only for observed ``(a, v, p)``
* ``score(u,p)`` ``sum of ll(a, v_u, p)`` over the matches of ``u``'s attributes,
                 plus ``ln prior(p)``; no row when nothing matches
* posterior     ``exp(score)``, not normalised

Unseen ``(a, v, p)`` contribute nothing (the inner join), and the smoothing
denominator is ``f + 1``; both are the reference semantics, which is why
``pyspark.ml.classification.NaiveBayes`` is not a drop-in replacement.

Forms of the model
------------------
*Vectors* (``fit_basket`` with ``products``, ``fit_snapshot``): one row per
``(attr, value)`` with one likelihood column per product of the catalogue, which
is schema-like (a snapshot has a flag column for each product).  A customer's
fact meets one row instead of one per product, the rows are summed elementwise,
and the facts go through one shuffle, on the customer, after a partial sum.
*Long* (catalogues unknown or beyond ``MAX_COLUMNS`` products): one row per
``(attr, value, product)``.  Both give the same rows.

Scale notes
-----------
* Training facts are reduced to one row per customer before any join, so a
  customer with a third of all orders is still one row.  That table is written
  once (reliable checkpoint); everything else derives from it without being
  persisted, and tables are measured only when a join needs their size.
* Attributes with few values ("narrow") give a small likelihood table; it is
  broadcast if its measured bytes allow, else joined with salted keys.
  Attributes with one value per customer ("wide", e.g. the customer id itself)
  are joined by an ordinary shuffle on ``(attr, value)``: each key holds one
  customer.  Their likelihoods are derived from the counts when they are needed.
* On shuffled paths copies of a scoring fact become one fact with a
  multiplicity before the join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nextbest.functions import scalars as X
from nextbest.operators.features import attr_long
from nextbest.operators.joins import BROADCAST_BYTES, DEFAULT_SALTS, join_small, measured_bytes
from nextbest.session import ensure_checkpoint_dir

SCORE_DECIMALS = 9
#: Products that a row may have a column for; generated code grows with them.
MAX_COLUMNS = 128


def _written(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class _Measured:
    """A small table that is written and measured once, when a join first asks for it."""

    def __init__(self, df: DataFrame) -> None:
        self.df, self._held, self._bytes = df, None, 0

    def get(self) -> tuple[DataFrame, int]:
        if self._held is None:
            self._held = _written(self.df)
            self._bytes = measured_bytes(self._held)
        return self._held, self._bytes


@dataclass(frozen=True)
class Vectors:
    """Likelihood vectors: ``(attr, value, c0.., l0..)``, column k for ``products[k]``.

    ``c`` is the count, ``l`` the log-likelihood (null where the count is 0).
    """

    products: list[str]
    log_prior: list[float | None]   # None: nobody owns the product
    narrow: DataFrame
    wide: DataFrame | None = None

    def long(self, rows: DataFrame) -> DataFrame:
        """``(attr, value, product, c, ll)`` of the observed combinations."""
        entries = F.array(*[F.struct(F.lit(p).alias("product"), F.col(f"c{k}").alias("c"),
                                     F.col(f"l{k}").alias("ll"))
                            for k, p in enumerate(self.products)])
        return rows.select("attr", "value", F.inline(F.filter(entries, lambda e: e["c"] > 0)))


@dataclass(frozen=True)
class NaiveBayesModel:
    """Fitted tables; none is persisted.

    prior       ``(product, f, n, prior, log_prior)``
    narrow      ``(attr, value, product, c, ll)`` of the attributes with few values
    wide        the same of the attributes with one value per customer, or None
    vectors     the same likelihoods as vectors, or None
    """

    prior: DataFrame
    narrow: DataFrame
    wide: DataFrame | None = None
    wide_attrs: tuple[str, ...] = ()
    vectors: Vectors | None = None
    _small: dict[str, _Measured] = field(default_factory=dict, repr=False, compare=False)

    @property
    def likelihood(self) -> DataFrame:
        return self.narrow if self.wide is None else self.narrow.unionByName(self.wide)

    def measured(self, name: str) -> tuple[DataFrame, int]:
        """``prior``, ``narrow`` or ``vectors`` (the narrow ones, likelihoods only), written
        once, and its bytes."""
        if name not in self._small:
            if name == "vectors":
                columns = [f"l{k}" for k in range(len(self.vectors.products))]
                df = self.vectors.narrow.select("attr", "value", *columns)
            elif name == "narrow":
                df = self.narrow.select("attr", "value", "product", "ll")
            else:
                df = self.prior.select("product", "log_prior")
            self._small[name] = _Measured(df)
        return self._small[name].get()


# --------------------------------------------------------------------------- counts

def total_instances(instances: DataFrame) -> DataFrame:
    """One row ``n``: the number of training instances."""
    return instances.agg(F.count(F.lit(1)).alias("n"))


def customer_product_counts(basket: DataFrame, customer: str = "customer",
                            product: str = "product") -> DataFrame:
    """``(customer, product, n)``: instances of the customer owning the product.

    ``basket`` holds distinct ``(instance, customer, product)`` facts.  The
    partial aggregate runs before the shuffle, so each map task emits at most
    one row per customer and product whatever the skew of customers.
    """
    return basket.groupBy(customer, product).agg(F.count(F.lit(1)).alias("n"))


def product_frequency(counts: DataFrame, product: str = "product",
                      weight: str | None = "n") -> DataFrame:
    """``(product, f)``; ``weight`` sums pre-aggregated counts, None counts rows."""
    f = F.sum(weight) if weight else F.count(F.lit(1))
    return counts.groupBy(product).agg(f.cast("bigint").alias("f"))


def product_prior(freq: DataFrame, n: Column | int) -> DataFrame:
    """``(product, f, n, prior, log_prior)`` with ``prior = f / n``."""
    n_col = n if isinstance(n, Column) else F.lit(n)
    return freq.select(
        "product", "f", n_col.cast("bigint").alias("n"),
        (F.col("f").cast("double") / n_col.cast("double")).alias("prior"),
        F.ln(F.col("f").cast("double") / n_col.cast("double")).alias("log_prior"),
    )


def attr_frequency(counts: DataFrame, attributes: DataFrame, attr_cols: list[str],
                   customer: str = "customer", product: str = "product") -> DataFrame:
    """``(attr, value, product, c)`` for attributes that belong to the customer.

    ``counts`` is ``(customer, product, n)``; ``attributes`` is wide, one row
    per customer.  The join keeps one row per owned pair and the unpivot to
    ``attr`` happens after it, so the shuffle moves one attribute row per
    customer instead of one per attribute.
    """
    joined = counts.join(attributes.select(customer, *attr_cols), customer)
    long = attr_long(joined, [product, "n"], attr_cols)
    return (long.groupBy("attr", "value", product)
            .agg(F.sum("n").cast("bigint").alias("c")))


def id_frequency(counts: DataFrame, id_attr: str, customer: str = "customer",
                 product: str = "product") -> DataFrame:
    """``(attr, value, product, c)`` for the customer id used as an attribute.

    With one id per customer, ``c(id=u, p)`` is just ``n(u, p)``: no join.
    """
    return counts.select(F.lit(id_attr).alias("attr"),
                         X.id_text(customer).alias("value"),
                         F.col(product).alias("product"),
                         F.col("n").cast("bigint").alias("c"))


def nb_likelihood(attr_freq: DataFrame, freq: DataFrame, max_bytes: int = BROADCAST_BYTES,
                  known_bytes: int | None = None) -> DataFrame:
    """``(attr, value, product, c, ll)`` with ``ll = ln((c + 1) / (f + 1))``."""
    joined = join_small(attr_freq, freq.select("product", "f"), ["product"],
                        max_bytes=max_bytes, known_bytes=known_bytes)
    return joined.select(
        "attr", "value", "product", "c",
        F.ln((F.col("c") + F.lit(1.0)) / (F.col("f") + F.lit(1.0))).alias("ll"))


# --------------------------------------------------------------------------- vectors

def owned_counts(basket: DataFrame, products: list[str], customer: str = "customer",
                 product: str = "product") -> DataFrame:
    """``(customer, c0..)``: instances of the customer that own each product of the catalogue.

    ``basket`` holds distinct ``(instance, customer, product)`` facts.  One
    partial aggregate: a map task emits at most one row per customer.
    """
    own = [F.count(F.when(F.col(product) == p, 1)).alias(f"c{k}") for k, p in enumerate(products)]
    return basket.groupBy(F.col(customer).alias("customer")).agg(*own)


def counts_long(counts: DataFrame, products: list[str]) -> DataFrame:
    """``owned_counts`` rows as ``(customer, product, n)``; keeps their partitioning."""
    entries = F.array(*[F.struct(F.lit(p).alias("product"), F.col(f"c{k}").alias("n"))
                        for k, p in enumerate(products)])
    return counts.select("customer", F.inline(F.filter(entries, lambda e: e["n"] > 0)))


def count_vectors(counts: DataFrame, attributes: DataFrame, attr_cols: list[str],
                  n_products: int, customer: str = "customer") -> DataFrame:
    """``(attr, value, c0..)`` for attributes that belong to the customer.

    The join keeps one row per customer; the unpivot to ``attr`` comes after it
    and its rows are summed in the map tasks.
    """
    own = [f"c{k}" for k in range(n_products)]
    joined = counts.join(attributes.select(customer, *attr_cols), customer)
    return attr_long(joined, own, attr_cols).groupBy("attr", "value").agg(
        *[F.sum(c).alias(c) for c in own])


def likelihood_vectors(by_value: DataFrame, freq: list[int]) -> DataFrame:
    """``(attr, value, c0.., l0..)`` with ``l = ln((c + 1) / (f + 1))``, null for a count of 0."""
    own = [f"c{k}" for k in range(len(freq))]
    return by_value.select("attr", "value", *own, *[
        F.when(F.col(c) > 0, F.ln((F.col(c) + F.lit(1.0)) / F.lit(f + 1.0))).alias(f"l{k}")
        for k, (c, f) in enumerate(zip(own, freq))])


def _frequencies(spark: SparkSession, products: list[str], freq: list[int]) -> DataFrame:
    """``(product, f)`` of the owned products, from scalars."""
    rows = [F.struct(F.lit(p).alias("product"), F.lit(f).cast("bigint").alias("f"))
            for p, f in zip(products, freq) if f > 0]
    if not rows:
        return spark.createDataFrame([], "product string, f long")
    return spark.range(1).select(F.inline(F.array(*rows)))


def _vector_model(spark: SparkSession, products: list[str], freq: list[int], n: int, narrow: DataFrame,
                  wide: DataFrame | None, wide_attrs: tuple[str, ...]) -> NaiveBayesModel:
    """From counts by value; ``freq`` and ``n`` are scalars of the catalogue's size."""
    prior = product_prior(_frequencies(spark, products, freq), n)
    vectors = Vectors(list(products), [math.log(f / n) if f > 0 else None for f in freq],
                      likelihood_vectors(narrow, freq),
                      None if wide is None else likelihood_vectors(wide, freq))
    return NaiveBayesModel(prior, vectors.long(vectors.narrow),
                           None if wide is None else vectors.long(vectors.wide), wide_attrs, vectors)


# --------------------------------------------------------------------------- fit

def fit_basket(instances: DataFrame, basket: DataFrame, attributes: DataFrame,
               attr_cols: list[str], id_attr: str | None = None,
               customer: str = "customer", product: str = "product",
               max_bytes: int = BROADCAST_BYTES, products: list[str] | None = None
               ) -> tuple[NaiveBayesModel, DataFrame]:
    """Fit from long purchase facts and per-customer attributes.

    ``instances``  one row per training instance (only counted)
    ``basket``     distinct ``(instance, customer, product)`` owned facts
    ``attributes`` wide ``(customer, attr_cols...)``, one row per customer
    ``id_attr``    name under which the customer id is also an attribute
    ``products``   the catalogue (text), if known: it has every product of the facts

    Returns the model and the ``(customer, product, n)`` counts, which are also
    the purchase history.  The counts are written once; with a catalogue that
    and the catalogue's totals are the only jobs.
    """
    attributes = attributes.withColumnRenamed(customer, "customer")
    wide_attrs = (id_attr,) if id_attr else ()
    if products is not None and len(products) <= MAX_COLUMNS:
        own = [f"c{k}" for k in range(len(products))]
        counts = _written(owned_counts(basket, products, customer, product))
        totals = counts.agg(*[F.sum(c).alias(c) for c in own]).select(
            "*", total_instances(instances).scalar().alias("n")).first()
        by_value = count_vectors(counts, attributes, attr_cols, len(products))
        by_id = counts.select(F.lit(id_attr).alias("attr"), X.id_text("customer").alias("value"),
                              *own) if id_attr else None
        model = _vector_model(basket.sparkSession, products, [totals[c] or 0 for c in own],
                              totals["n"], by_value, by_id, wide_attrs)
        return model, counts_long(counts, products)
    counts = customer_product_counts(basket, customer, product)
    counts = _written(counts.withColumnsRenamed({customer: "customer", product: "product"}))
    prior = _written(product_prior(product_frequency(counts), total_instances(instances).scalar()))
    freq, size = prior.select("product", "f"), measured_bytes(prior)
    rows = attr_frequency(counts, attributes, attr_cols)
    narrow = nb_likelihood(rows, freq, max_bytes, size)
    wide = nb_likelihood(id_frequency(counts, id_attr), freq, max_bytes, size) if id_attr else None
    return NaiveBayesModel(prior, narrow, wide, wide_attrs), counts


def fit_snapshot(snapshot: DataFrame, attr_cols: list[str], product_cols: list[str],
                 wide_attrs: tuple[str, ...] = (),
                 max_bytes: int = BROADCAST_BYTES) -> NaiveBayesModel:
    """Fit from wide snapshot rows: attribute columns plus product flags.

    Each row is an instance whose own attribute values count.  Attributes are
    unpivoted (one row per attribute) carrying all flags, then grouped by
    ``(attr, value)`` with one ``sum`` per product.  A constant attribute rides
    along whose only group is the whole table: it holds the number of instances
    and the product frequencies, so one read of the snapshot gives everything.
    The catalogue comes from the schema; its totals alone reach the driver.
    """
    own = [f"c{k}" for k in range(len(product_cols))]
    flags = [F.coalesce(X.flag(p), F.lit(0)).alias(c) for p, c in zip(product_cols, own)]
    rows = snapshot.select(*attr_cols, *flags).withColumn(_ALL, F.lit(1))
    by_value = _written(attr_long(rows, own, [*attr_cols, _ALL]).groupBy("attr", "value").agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(c).cast("bigint").alias(c) for c in own]))
    total = by_value.where(F.col("attr") == _ALL).first()
    freq, n = ([total[c] for c in own], total["__n"]) if total else ([0] * len(own), 0)
    counted = by_value.where(F.col("attr") != _ALL).drop("__n")
    is_wide = F.col("attr").isin(list(wide_attrs))
    if len(product_cols) <= MAX_COLUMNS:
        return _vector_model(snapshot.sparkSession, list(product_cols), freq, n,
                             counted.where(~is_wide) if wide_attrs else counted,
                             counted.where(is_wide) if wide_attrs else None, tuple(wide_attrs))
    prior = product_prior(_frequencies(snapshot.sparkSession, product_cols, freq), n)
    named = counted.withColumnsRenamed(dict(zip(own, product_cols)))
    attr_freq = named.unpivot(["attr", "value"], product_cols, "product", "c").where(F.col("c") > 0)
    lik = nb_likelihood(attr_freq, prior.select("product", "f"), max_bytes)
    return NaiveBayesModel(prior, lik.where(~is_wide) if wide_attrs else lik,
                           lik.where(is_wide) if wide_attrs else None, tuple(wide_attrs))


_ALL = "__all"


# --------------------------------------------------------------------------- score

def scoring_facts(scoring: DataFrame, attr_cols: list[str], id_attr: str | None = None,
                  customer: str = "customer") -> DataFrame:
    """``(customer, attr, value)`` rows of the customers to score."""
    base = scoring.select(F.col(customer).alias("customer"), *attr_cols)
    cols = list(attr_cols)
    if id_attr and id_attr not in cols:
        base = base.withColumn(id_attr, X.id_text("customer"))
        cols.append(id_attr)
    return attr_long(base, ["customer"], cols)


def nb_match(model: NaiveBayesModel, facts: DataFrame, max_bytes: int = BROADCAST_BYTES,
             salts: int = DEFAULT_SALTS) -> DataFrame:
    """``(customer, product, ll)``: every likelihood matched by a customer fact.

    Copies of a fact are one row with a multiplicity (a partial aggregate), so a
    customer on many scoring rows adds one row per attribute to any shuffle.
    The facts are then dealt out by customer, which the sums, the history and
    the ranking that follow can keep.
    """
    wide = list(model.wide_attrs)
    facts = facts.groupBy("customer", "attr", "value").agg(F.count(F.lit(1)).alias("__m"))
    is_wide = F.col("attr").isin(wide) if wide else F.lit(False)
    weighted = (F.col("ll") * F.col("__m")).alias("ll")
    narrow, size = model.measured("narrow")
    matched = join_small(facts.where(~is_wide).repartition("customer"), narrow, ["attr", "value"],
                         max_bytes=max_bytes, salts=salts, salt_by=["customer", "attr"],
                         known_bytes=size).select("customer", "product", weighted)
    if model.wide is not None:
        own = facts.where(is_wide).join(model.wide.select("attr", "value", "product", "ll"),
                                        ["attr", "value"])
        matched = matched.unionByName(
            own.select("customer", "product", weighted).repartition("customer"))
    return matched


def nb_score(model: NaiveBayesModel, facts: DataFrame, max_bytes: int = BROADCAST_BYTES,
             salts: int = DEFAULT_SALTS) -> DataFrame:
    """``(customer, product, score)``: summed log-likelihoods plus log prior.

    A customer on several scoring rows gets each row's likelihoods and the
    prior once.  Scores are rounded to 9 decimals so ranks do not depend on
    the order of the floating-point sum.  The rows are partitioned by customer.
    """
    if model.vectors is not None:
        return _vector_score(model, facts, max_bytes, salts)
    summed = (nb_match(model, facts, max_bytes, salts)
              .groupBy("customer", "product").agg(F.sum("ll").alias("ll_sum")))
    prior, size = model.measured("prior")
    scored = join_small(summed, prior, ["product"], max_bytes=max_bytes,
                        salts=salts, salt_by=["customer"], known_bytes=size)
    return scored.select(
        "customer", "product",
        F.round(F.col("ll_sum") + F.col("log_prior"), SCORE_DECIMALS).alias("score"))


def _vector_score(model: NaiveBayesModel, facts: DataFrame, max_bytes: int, salts: int) -> DataFrame:
    """One joined row per fact; vectors summed in the map tasks, then once per customer.

    A repeated fact adds its vector again.  Vectors that may not be broadcast
    meet the facts in a shuffle, where copies of a fact are one row.
    """
    v = model.vectors
    columns = [f"l{k}" for k in range(len(v.products))]
    is_wide = F.col("attr").isin(list(model.wide_attrs)) if model.wide_attrs else F.lit(False)
    narrow, size = model.measured("vectors")

    def weighted(rows: DataFrame) -> DataFrame:
        return rows.select("customer", *[(F.col(c) * F.col("__m")).alias(c) for c in columns])

    def collapsed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("customer", "attr", "value").agg(F.count(F.lit(1)).alias("__m"))

    if size <= max_bytes:
        matched = facts.where(~is_wide).join(F.broadcast(narrow), ["attr", "value"]).select(
            "customer", *columns)
    else:
        matched = weighted(join_small(collapsed(facts.where(~is_wide)), narrow, ["attr", "value"],
                                      max_bytes=max_bytes, salts=salts,
                                      salt_by=["customer", "attr"], known_bytes=size))
    if v.wide is not None:
        own = collapsed(facts.where(is_wide)).join(
            v.wide.select("attr", "value", *columns), ["attr", "value"])
        matched = matched.unionByName(weighted(own))
    summed = matched.groupBy("customer").agg(*[F.sum(c).alias(c) for c in columns])
    scores = F.array(*[
        F.struct(F.lit(p).alias("product"),
                 F.round(F.col(c) + F.lit(lp).cast("double"), SCORE_DECIMALS).alias("score"))
        for p, c, lp in zip(v.products, columns, v.log_prior)])
    return summed.select("customer", F.inline(F.filter(
        scores, lambda s: s["score"].isNotNull())))


def posterior_prob(scores: DataFrame) -> DataFrame:
    """Add ``posterior = exp(score)`` (unnormalised, may underflow to 0)."""
    return scores.withColumn("posterior", F.exp("score"))
