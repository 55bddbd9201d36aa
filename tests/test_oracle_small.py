"""Every registered query against its DuckDB oracle at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from nextbest.plans import queries as R

from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


@pytest.mark.parametrize("name", sorted(R.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = R.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = duck.execute(R.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want


def test_every_query_has_an_oracle():
    assert set(R.queries()) == set(R.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["customer", "rank", "product", "score"]
    assert df.count() > 0
