"""Whitening: the spectral splits against numpy's solver, the query against plain Python."""

import math

import numpy as np
import pytest

from nextbest.llm import whitening_qdwh as wh
from nextbest.llm.whitening_query import op13_embedding_whitening
from tests.conftest import SF_SMALL


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize("values", [
    [5.0], [3.0, 1.0], list(range(1, 65)), [1.0] * 10, [2.0] * 5 + [1.0] * 5, [0.0] * 6 + [1, 2],
    [10.0 ** -k for k in range(10)], [1, 1 + 1e-9, 1 - 1e-9, 4], [-3.0, -1, 0, 1, 3],
    [1e6] + [1.0] * 20])
def test_components_diagonalise(values):
    a = symmetric(values)
    got, rows = wh.principal_components((a + a.T) / 2)
    scale = max(map(abs, values))
    assert np.allclose(got, sorted(values, reverse=True), atol=1e-13 * scale * len(values))
    assert np.allclose(rows @ rows.T, np.eye(len(values)), atol=1e-13)
    assert np.allclose(rows @ a @ rows.T, np.diag(got), atol=1e-13 * scale * len(values))


def test_well_parted_components_are_those_of_numpy():
    a = symmetric([2.0 ** k for k in range(12)])
    got, rows = wh.principal_components((a + a.T) / 2)
    values, vectors = np.linalg.eigh(a)
    assert np.allclose(np.abs(np.sum(rows * vectors.T[::-1], axis=1)), 1, atol=1e-13)
    assert np.allclose(got, values[::-1], rtol=1e-10)


def test_polar_factor():
    a = symmetric([-4.0, -1e-8, 1e-3, 2, 9])
    u = wh.qdwh(a)
    assert np.allclose(u @ u, np.eye(5), atol=1e-12)
    h = u @ a
    assert np.allclose(h, h.T, atol=1e-7) and np.linalg.eigvalsh((h + h.T) / 2).min() > -1e-7
    assert wh.qdwh(np.zeros((3, 3))) is None


def plain(rows, components=32):
    good = [(i, [math.floor(64 * float(c)) + 1000000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(good), len(good[0][1])
    sums = [sum(x[k] for _, x in good) for k in range(d)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for _, x in good])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors.T[::-1]
    return {"n": n, "deviation": {i: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for i, x in good},
            "explained": values / values.sum(), "values": values, "vectors": vectors,
            "whitened": {i: (vectors[:components] @ c) / np.sqrt(values[:components])
                         for (i, _), c in zip(good, centred)}}


def test_query_matches_the_plain_version(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    want = plain([(r["vec_id"], r["embedding"]) for r in table.collect()])
    got = op13_embedding_whitening(spark, SF_SMALL)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"]
    rows = got.toPandas()
    assert len(rows) == 32 * want["n"] and set(rows["n"]) == {want["n"]}
    assert rows["identity_error"].nunique() == 1 and rows["identity_error"].iloc[0] < 1e-9
    for i, own in rows.groupby("vec_id"):
        own = own.sort_values("component")
        assert own["component"].tolist() == list(range(1, 33))
        assert set(own["deviation"]) == {want["deviation"][i]}
        assert np.allclose(own["explained"], want["explained"][:32], rtol=1e-9)
    wide = rows.pivot(index="vec_id", columns="component", values="whitened").sort_index()
    plain_wide = np.array([want["whitened"][i] for i in wide.index])
    sign = np.sign((wide.to_numpy() * plain_wide).sum(axis=0))
    assert np.allclose(wide.to_numpy() * sign, plain_wide, atol=1e-8)


def test_split_of_rows_does_not_matter(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    a = wh.fit_whitening(wh.clean_vectors(table))[0]
    b = wh.fit_whitening(wh.clean_vectors(table.repartition(7)))[0]
    assert a.sums == b.sums and (a.rows == b.rows).all() and (a.values == b.values).all()


def test_odd_rows(spark):
    """Null and unusable vectors, other lengths, repeated rows, null ids, clashing columns."""
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, 0.9, 0.0]), (1, [0.1, 0.9, 0.0]), (None, [0.5, -0.25, 1.0]), (3, None),
            (4, [0.1, None, 0.2]), (5, [nan, 0.1, 0.2]), (6, [0.1, inf, 0.2]), (7, []), (8, [0.5, 0.5]),
            (9, [1.0, 2.0, -3.0])]
    table = spark.createDataFrame([(*r, 1, 0.5) for r in rows],
                                  "vec_id int, embedding array<float>, n int, whitened double")
    got = wh.whitened(table).toPandas()
    want = plain([r for r in rows if r[1] is None or len(r[1]) == 3])
    assert set(got["n"]) == {4} and len(got) == 4 * 3
    assert got["vec_id"].isna().sum() == 3
    assert set(got["deviation"]) == set(want["deviation"].values())
    assert got["identity_error"].max() < 1e-9
    first = got.drop_duplicates("component").sort_values("component")["explained"]
    assert np.allclose(first, want["explained"], atol=1e-12)
    assert wh.whitened(table.limit(0)).count() == 0
    assert wh.whitened(table.where("vec_id in (3, 7)")).count() == 0


def test_components_without_variance(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25])] * 3, "vec_id long, embedding array<double>")
    rows = wh.whitened(one).collect()
    assert len(rows) == 6
    assert {(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in rows} == {
        (0, 0.0, 0.0, 0.0)}
    flat = spark.createDataFrame([(i, [float(i), 7.0]) for i in range(5)],
                                 "vec_id long, embedding array<double>")
    by = {(r["vec_id"], r["component"]): r for r in wh.whitened(flat).collect()}
    assert by[0, 1]["explained"] == 1.0 and by[0, 2]["explained"] == 0.0
    assert abs(abs(by[0, 1]["whitened"]) - math.sqrt(2)) < 1e-12
    assert by[0, 2]["whitened"] == 0.0 and by[0, 1]["identity_error"] < 1e-9


def test_large_entries_stay_exact(spark):
    values = [1e12, -3e12, 5e11, 0.25]
    table = spark.createDataFrame([(i, [v, 1.0 + i]) for i, v in enumerate(values)],
                                  "vec_id long, embedding array<double>")
    x = [[math.floor(64 * v) + 1000000, 64 * (1 + i) + 1000000] for i, v in enumerate(values)]
    sums = [sum(c) for c in zip(*x)]
    exact = [sum((4 * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    got = {r["vec_id"]: r["deviation"] for r in wh.whitened(table).collect()}
    assert got == {i: e if e < 1 << 63 else None for i, e in enumerate(exact)}
