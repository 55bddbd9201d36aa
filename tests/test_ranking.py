"""Distributed positions and medians against pandas, with one hot group."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest

from nextbest.operators import clean, ranking
from nextbest.operators.ranking import exact_median, lower_median, positions


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 4000
    g = np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", "c"], n))
    v = rng.integers(0, 500, n).astype(float)
    v[rng.random(n) < 0.05] = np.nan
    pdf = pd.DataFrame({"g": g, "v": v})
    return pdf, spark.createDataFrame(pdf).replace(float("nan"), None)


def test_positions_are_a_permutation_per_group(spark, skewed):
    pdf, df = skewed
    p = positions(df.where("v is not null"), ["v"], ["g"], partitions=7).toPandas()
    for g, part in p.groupby("g"):
        assert sorted(part["pos"]) == list(range(1, len(part) + 1))
        assert list(part.sort_values("pos")["v"]) == sorted(part["v"])


def test_exact_median_matches_pandas(spark, skewed):
    pdf, df = skewed
    got = {r.g: r.median for r in exact_median(df, "v", ["g"]).collect()}
    want = pdf.groupby("g")["v"].median().to_dict()
    assert got == pytest.approx(want)
    assert exact_median(df, "v").first()["median"] == pytest.approx(pdf["v"].median())


def test_lower_median_matches_percentile_disc(spark, skewed):
    pdf, df = skewed
    got = {r.g: r.median for r in lower_median(df, "v", ["g"]).collect()}
    for g, s in pdf.groupby("g")["v"]:
        vals = np.sort(s.dropna().to_numpy())
        assert got[g] == vals[(len(vals) - 1) // 2]


def test_medians_with_one_value_holding_most_rows(spark):
    rng = np.random.default_rng(3)
    v = np.where(rng.random(3000) < 0.7, 0.0, rng.integers(1, 9, 3000).astype(float))
    g = np.where(rng.random(3000) < 0.5, "x", "y")
    pdf = pd.DataFrame({"g": g, "v": v})
    df = spark.createDataFrame(pdf)
    got = {r.g: r.median for r in exact_median(df, "v", ["g"]).collect()}
    assert got == pytest.approx(pdf.groupby("g")["v"].median().to_dict())
    low = {r.g: r.median for r in lower_median(df, "v", ["g"]).collect()}
    for key, s in pdf.groupby("g")["v"]:
        vals = np.sort(s.to_numpy())
        assert low[key] == vals[(len(vals) - 1) // 2]


def test_weighted_positions_cover_counts(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 2.0, 1), ("b", 5.0, 2), ("a", 0.5, 2)],
                               "g string, v double, w long")
    got = {(r.g, r.v): r.pos for r in positions(df, ["v"], ["g"], weight="w").collect()}
    assert got == {("a", 0.5): 2, ("a", 1.0): 5, ("a", 2.0): 6, ("b", 5.0): 2}


@pytest.mark.parametrize("off", [-0.4, -0.05, 0.3])
def test_a_bracket_that_misses_is_widened(spark, monkeypatch, off):
    """Brackets far from the middle: every group is found on the side that holds it."""
    real = ranking.F.percentile_approx

    def wrong(key, percentages, accuracy):
        if len(percentages) == 2:
            percentages = [p + off for p in percentages]
        return real(key, percentages, accuracy)

    monkeypatch.setattr(ranking.F, "percentile_approx", wrong)
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 3001, p=[0.7, 0.2999, 0.0001]),
                        "v": rng.integers(0, 900, 3001).astype(float)})
    pdf.loc[0] = ["c", 5.0]
    df = spark.createDataFrame(pdf)
    got = {r.g: r.median for r in exact_median(df, "v", ["g"]).collect()}
    assert got == pytest.approx(pdf.groupby("g")["v"].median().to_dict())
    low = {r.g: r.median for r in lower_median(df, "v", ["g"]).collect()}
    assert low == {g: np.sort(s)[(len(s) - 1) // 2] for g, s in pdf.groupby("g")["v"]}


def test_one_task_orders_a_bounded_number_of_values(spark, monkeypatch):
    """Brackets with more values than a task may order are cut first; copies weigh as many."""
    monkeypatch.setattr(ranking, "ORDERED_ROWS", 20)
    monkeypatch.setattr(ranking, "_MARGIN", 0.4)
    ordered = []
    real = ranking._narrowed

    def seen(held, info):
        out = real(held, info)
        ordered.extend(r["count"] for r in out[0].groupBy("__k").count().collect())
        return out

    monkeypatch.setattr(ranking, "_narrowed", seen)
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 6000), "v": rng.integers(0, 10**6, 6000)})
    pdf.loc[pdf.index[:2500], "v"] = 400_000   # copies beside the middle
    pdf.loc[6000] = ["tiny", 3]
    df = spark.createDataFrame(pdf)
    got = {r.g: float(r.median) for r in exact_median(df, "v", ["g"]).collect()}
    assert got == pytest.approx(pdf.groupby("g")["v"].median().to_dict())
    assert ordered and max(ordered) <= 20


def test_medians_keep_their_type(spark):
    """Longs beyond 2^53, decimals and microseconds are exact."""
    big = [2**60 + k for k in (1, 3, 5, 8)]
    df = spark.createDataFrame([(b, Decimal(b) / 100) for b in big], "l long, d decimal(30,2)")
    assert exact_median(df, "l").first()["median"] == Decimal(2**60 + 4)
    assert lower_median(df, "l").first()["median"] == 2**60 + 3
    assert exact_median(df, "d").first()["median"] == Decimal(2**60 + 4) / 100
    assert lower_median(df, "d").first()["median"] == Decimal(2**60 + 3) / 100
    odd = spark.createDataFrame([(2**62 + 1,), (2**62 + 2,)], "l long")
    assert exact_median(odd, "l").first()["median"] == Decimal(2**62) + Decimal("1.5")
    filled = clean.median_fill(spark.createDataFrame([(2**60 + 1,), (2**60 + 1,), (None,)], "l long"), "l")
    assert {r.l for r in filled.collect()} == {2**60 + 1}
    at = dt.datetime(2020, 1, 1, 1, 2, 3, 456789)
    times = spark.createDataFrame([(at,), (at + dt.timedelta(microseconds=1),)], "t timestamp")
    assert lower_median(times, "t").first()["median"] == at


def test_nulls_that_count_stand_last(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", None), ("b", 5), ("b", None), ("b", None)],
                               "g string, v int")
    got = {r.g: r.median for r in lower_median(df, "v", ["g"], nulls_counted=True).collect()}
    assert got == {"a": 2, "b": None}
    assert {r.g: r.median for r in lower_median(df, "v", ["g"]).collect()} == {"a": 1, "b": 5}
