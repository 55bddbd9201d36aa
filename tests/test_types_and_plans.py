"""Mixed types, missing values, order on many partitions, and reads of the input."""

import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from nextbest.functions import scalars as X
from nextbest.operators import bayes, clean, encode, features, recommend
from nextbest.operators.joins import split_join
from nextbest.operators.ranking import exact_median, lower_median, positions
from nextbest.plans import pipeline as P
from nextbest.plans import standins as S
from nextbest.sources import records

from conftest import SF_SMALL


def test_only_plain_numbers_are_numbers(spark):
    texts = [" 12 ", "-1.5", "1e3", ".5", "12d", "7f", "0x1p3", "NaN", "", None, "1,2", "Infinity"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.n for r in df.select(X.numeric_coerce("t").alias("n")).collect()]
    assert got == [12.0, -1.5, 1000.0, 0.5, *[None] * 8]
    nan = spark.createDataFrame([(math.nan,), (2.0,)], "t double")
    assert [r.n for r in nan.select(X.numeric_coerce("t").alias("n")).collect()] == [None, 2.0]


def test_attribute_text_is_the_same_in_every_numeric_type(spark):
    df = spark.createDataFrame([(1, 55, 55.0, "55", None), (2, None, math.nan, None, 2.5)],
                               "k int, i int, d double, s string, x double")
    df = df.withColumn("m", F.col("i").cast("decimal(10,2)"))
    got = {(r.k, r.attr): r.value
           for r in features.attr_long(df, ["k"], ["i", "d", "s", "x", "m"]).collect()}
    assert {v for (k, a), v in got.items() if k == 1 and a != "x"} == {"55"}
    assert got[1, "x"] == "" and got[2, "x"] == "2.5"
    assert {v for (k, a), v in got.items() if k == 2 and a != "x"} == {""}


def _fit(spark, rows, schema, **kw):
    return bayes.fit_snapshot(spark.createDataFrame(rows, schema), ["a"], ["p", "q"], **kw)


def test_missing_matches_missing_and_int_matches_double(spark):
    model = _fit(spark, [(55, "1.0", "0"), (None, " 1", None)], "a int, p string, q string")
    score = spark.createDataFrame([(1, 55.0), (2, None), (3, 7.0)], "customer int, a double")
    got = {(r.customer, r.product) for r in bayes.nb_score(
        model, bayes.scoring_facts(score, ["a"])).collect()}
    assert got == {(1, "p"), (2, "p")}
    assert [(r["product"], r.f, r.n) for r in model.prior.collect()] == [("p", 2, 2)]


def test_text_ids_meet_their_own_history(spark):
    basket = spark.createDataFrame([(1, "007", "p"), (2, "ab", "q")],
                                   "o int, customer string, product string")
    attrs = spark.createDataFrame([("007", "x"), ("ab", "x")], "customer string, a string")
    model, _ = bayes.fit_basket(basket, basket, attrs, ["a"], "id")
    assert {(r.attr, r.value) for r in model.wide.collect()} == {("id", "7"), ("id", "ab")}
    facts = bayes.scoring_facts(attrs, ["a"], "id")
    assert {(r.customer, r.product) for r in bayes.nb_match(model, facts).collect()} == {
        ("007", "p"), ("007", "q"), ("ab", "p"), ("ab", "q")}
    own = [r for r in bayes.nb_match(model, facts).collect() if r.customer == "007"]
    assert len(own) == 3  # two by the attribute, one by the id


def test_flags_in_any_spelling(spark):
    df = spark.createDataFrame([(1, "1.0", " 1", "0"), (2, None, "", "2")],
                               "k int, p string, q string, r string")
    assert {(r.k, r["product"]) for r in
            features.purchase_long(df, ["k"], ["p", "q", "r"]).collect()} == {(1, "p"), (1, "q")}
    got = [tuple(r) for r in clean.cast_flags(df, ["p", "q", "r"]).orderBy("k").collect()]
    assert got == [(1, 1, 1, 0), (2, None, None, 2)]


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([("a", 3.0), (None, 1.0), (None, 2.0), ("a", 5.0), (None, 9.0),
                                ("null", 4.0)], "g string, v double")
    got = {(r.g, r.v): r.pos for r in positions(df, ["v"], ["g"], partitions=3).collect()}
    assert got == {("a", 3.0): 1, ("a", 5.0): 2, (None, 1.0): 1, (None, 2.0): 2, (None, 9.0): 3,
                   ("null", 4.0): 1}
    assert {r.g: r.median for r in exact_median(df, "v", ["g"]).collect()} == {
        "a": 4.0, None: 2.0, "null": 4.0}
    holes = df.withColumn("v", F.when(F.col("v") != 9, F.col("v")))
    filled = {(r.g, r.v) for r in clean.group_median_fill(holes, "v", "g").collect()}
    assert (None, 1.5) in filled


def test_medians_of_text_are_refused(spark):
    with pytest.raises(TypeError):
        exact_median(spark.createDataFrame([("9",), ("10",)], "v string"), "v")


def test_median_beyond_the_sketch(spark):
    df = spark.range(60_001).select((F.col("id") * 7919 % 60_001).cast("double").alias("v"))
    skewed = df.unionByName(spark.range(30_000).select(F.lit(-1.0).alias("v")))
    # 90,001 values, 30,000 of them -1: the middle one is at 0-based 45,000
    assert exact_median(skewed, "v").first()["median"] == 15_000.0
    day = df.select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("v").cast("int")).alias("d"))
    assert lower_median(day, "d").first()["median"] == dt.date(2000, 1, 1) + dt.timedelta(30_000)


def test_sorts_order_many_partitions_with_nulls(spark):
    rows = [(None if i % 17 == 0 else (i * 7919) % 503, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(13)
    got = [(r.a, r.b) for r in clean.sort_snapshot(df, ["a", "b"]).collect()]
    assert got == sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    recs = spark.createDataFrame([(str(i * 7919 % 2003), f"{i}") for i in range(2003)],
                                 "customer string, value string").repartition(11)
    assert [int(r.customer) for r in recommend.sort_records(recs).collect()] == list(range(2003))


def test_values_unseen_in_training_get_their_code(spark):
    train = spark.createDataFrame([(1, "x"), (2, "y")], "d int, c string")
    codes = encode.category_dictionary(train, ["c"], ["d"])
    test = spark.createDataFrame([("y",), ("new",), (None,)], "c string")
    for limit in (0, 1 << 20):  # joined by shuffle, and broadcast
        got = encode.encode_categories(test, codes, ["c"], unseen_code=0, max_bytes=limit)
        assert sorted(r.c if r.c is not None else -1 for r in got.collect()) == [-1, 0, 2]


def test_usual_missing_tokens_are_null(spark):
    df = spark.createDataFrame([(t,) for t in ["NULL", " null", "NaN", "<NA>", "N/A", "ok", "-999999"]],
                               "t string")
    assert [r.t for r in records.null_tokens(df).collect()] == [*[None] * 5, "ok", None]


def test_a_brand_outside_the_usual_catalogue_is_a_column(spark, tmp_path):
    for name in ("orders", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    part.withColumn("p_brand", F.when(F.col("p_partkey") == 1, "Brand#26").otherwise(
        F.col("p_brand"))).write.parquet(f"{tmp_path}/part.parquet")
    t = S.Tables(spark, str(tmp_path))
    assert "Brand#26" in S.brand_catalogue(t)
    flags = S.brand_flags(t, cutoff=None)
    want = t.read("lineitem").where("l_partkey = 1").select("l_orderkey").distinct().count()
    assert flags.agg(F.sum("`Brand#26`")).first()[0] == want > 0


def _as_text(raw):
    """The raw snapshot as a CSV scan gives it: all text, flags and blanks included."""
    return raw.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                        for c in raw.columns])


def test_typed_and_text_snapshots_clean_alike(spark):
    raw = S.raw_snapshot(S.Tables(spark, SF_SMALL))
    typed = clean.clean_snapshot(raw, drop_late=False)
    text = clean.clean_snapshot(records.null_tokens(_as_text(raw)), drop_late=False)
    as_rows = lambda df: sorted(str(tuple(
        round(v, 6) if isinstance(v, float) else str(v) for v in r)) for r in df.collect())
    assert as_rows(typed) == as_rows(text.select(*typed.columns))


def test_clean_snapshot_reads_its_input_three_times(spark, tmp_path):
    raw = S.raw_snapshot(S.Tables(spark, SF_SMALL))
    raw.write.parquet(f"{tmp_path}/raw")
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    source = spark.read.parquet(f"{tmp_path}/raw")
    n = source.count()
    counted = source.mapInArrow(count, source.schema)
    clean.clean_snapshot(counted).write.format("noop").mode("overwrite").save()
    assert reads.value <= 3 * n


def test_an_empty_snapshot_cleans_to_an_empty_one(spark):
    raw = S.raw_snapshot(S.Tables(spark, SF_SMALL))
    assert clean.clean_snapshot(raw.limit(0)).count() == 0


def test_write_table_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "k int, t string")
    records.write_table(df, f"{tmp_path}/p")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/p").collect())) == [(1, "a,b"), (2, None)]
    records.write_table(df, f"{tmp_path}/c", "csv")
    assert sorted((r.k, r.t) for r in records.read_snapshot_csv(spark, f"{tmp_path}/c").collect()) \
        == [("1", "a,b"), ("2", None)]


def test_vector_and_long_models_agree(spark, monkeypatch):
    """The same prior, likelihoods and scores, with repeated scoring facts, broadcast or not."""
    t = S.Tables(spark, SF_SMALL)
    orders, attrs = S.orders_between(t, None, S.TRAIN_CUTOFF), S.customer_attributes(t)
    facts, brands = S.basket(t, orders), S.brand_catalogue(t)

    def rows(df):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r)
                      for r in df.collect())

    scored = bayes.scoring_facts(attrs, S.ATTR_COLS, S.ID_ATTR)
    scored = scored.unionByName(scored.where("customer % 3 = 0"))
    long, counts = bayes.fit_basket(orders, facts, attrs, S.ATTR_COLS, S.ID_ATTR)
    vector, own = bayes.fit_basket(orders, facts, attrs, S.ATTR_COLS, S.ID_ATTR, products=brands)
    assert long.vectors is None and vector.vectors is not None
    assert rows(counts) == rows(own.select(*counts.columns))
    assert rows(long.prior) == rows(vector.prior)
    assert rows(long.likelihood) == rows(vector.likelihood)
    want = rows(bayes.nb_score(long, scored))
    assert want == rows(bayes.nb_score(vector, scored))
    assert want == rows(bayes.nb_score(vector, scored, max_bytes=0, salts=3))
    monkeypatch.setattr(bayes, "MAX_COLUMNS", 3)
    assert bayes.fit_basket(orders, facts, attrs, S.ATTR_COLS, products=brands)[0].vectors is None


def test_scores_shuffle_the_facts_once_and_nothing_stays_persisted(spark):
    t = S.Tables(spark, SF_SMALL)
    fitted = P.fit_standin(t)
    narrow = bayes.scoring_facts(fitted.attributes, S.ATTR_COLS)
    plan = bayes.nb_score(fitted.model, narrow)._jdf.queryExecution().executedPlan().toString()
    # the narrow facts meet a broadcast row each and are summed before their only exchange
    # (the other one collapses copies of the id facts)
    assert len(re.findall(r"Exchange hashpartitioning\(customer#\d+L?, \d+\)", plan)) == 1
    P.recommend_standin(t).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_encoding_joins_only_large_columns(spark, monkeypatch):
    rows = [(i, f"v{i % 40}", f"w{i % 7}" if i % 5 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "d int, a string, b string")
    codes = encode.category_dictionary(df.where("d < 200"), ["a", "b"], ["d"])
    test = df.unionByName(spark.createDataFrame([(-1, "new", "w1")], df.schema))
    nested = encode.encode_categories(test, codes, ["a", "b"], unseen_code=0)
    assert "Join" not in nested._jdf.queryExecution().executedPlan().toString()
    want = sorted(map(str, nested.collect()))
    monkeypatch.setattr(encode, "NESTED_VALUES", 10)
    mixed = encode.encode_categories(test, codes, ["a", "b"], unseen_code=0)
    assert mixed._jdf.queryExecution().executedPlan().toString().count("Join") == 1
    assert sorted(map(str, mixed.collect())) == want
    assert sorted(map(str, encode.encode_categories(
        test, codes, ["a", "b"], unseen_code=0, max_bytes=0).collect())) == want
    none = encode.encode_categories(test, codes.limit(0), ["a", "b"])
    assert {(r.a, r.b) for r in none.collect()} == {(None, None)}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_are_joined_apart(spark, how):
    big = spark.createDataFrame([(i % 50 if i % 3 else 7, i) for i in range(600)] + [(None, -1)],
                                "k int, v int")
    small = spark.createDataFrame([(i, f"s{i}") for i in range(0, 40)] + [(7, "again")], "k int, s string")
    want = sorted(map(str, big.join(small, ["k"], how).collect()))
    for limit in (0, 1 << 20):
        got = split_join(big, small, ["k"], how, hot_rows=100, max_bytes=limit)
        assert sorted(map(str, got.select("k", "v", "s").collect())) == want
    assert sorted(map(str, split_join(big, small, ["k"], how).collect())) == want


def test_lines_with_a_wrong_number_of_fields(spark, tmp_path):
    (tmp_path / "s.csv").write_text('a,b\n1,2\n3\n4,5,6\n"x,y",NA\n')
    path = f"{tmp_path}/s.csv"
    want = {("1", "2"), ("3", None), ("4", "5"), ("x,y", None)}
    assert {tuple(r) for r in records.read_snapshot_csv(spark, path).collect()} == want
    kept = records.read_snapshot_csv(spark, path, bad_records="keep")
    assert {(r.a, r.b) for r in kept.collect()} == want
    assert {r["_bad_record"] for r in kept.collect()} == {None, "3", "4,5,6"}
    with pytest.raises(Exception, match="(?i)malformed"):
        records.read_snapshot_csv(spark, path, bad_records="raise").collect()
    (tmp_path / "good.csv").write_text("a,b\n1,2\n")
    assert records.read_snapshot_csv(spark, f"{tmp_path}/good.csv", bad_records="raise").count() == 1
    records.write_table(kept, f"{tmp_path}/out")
    with pytest.raises(Exception, match="(?i)exists"):
        records.write_table(kept, f"{tmp_path}/out", mode="error")
