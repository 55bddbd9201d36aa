"""Whole jobs over hand-made tables: complete results, and rows that stay narrow on the way."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from nextbest.operators import clean, features
from nextbest.plans import queries as R
from nextbest.plans import standins as S


def _tables(spark, folder, customers, orders, lines, parts):
    """customers: [id]; orders: [(key, customer, date)]; lines: [(order, part)]; parts: [(key, brand)]."""
    rows = {
        "customer": (customers, "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double"),
        "orders": ([(k, c, dt.datetime.fromisoformat(d)) for k, c, d in orders],
                   "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "lineitem": (lines, "l_orderkey long, l_partkey long"),
        "part": (parts, "p_partkey long, p_brand string"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def _nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def test_sorted_records_are_the_ranked_lists(spark, tmp_path):
    """Every scored customer, cold ones too, with the best products that are not owned yet."""
    sf = _tables(spark, tmp_path,
                 [(10, 1, "X", 50.0), (2, 1, "X", 70.0), (1, 1, "X", 90.0)],
                 [(1, 1, "1995-01-01"), (2, 2, "1995-02-01"), (3, 2, "1995-03-01")],
                 [(1, 1), (2, 2), (3, 2), (3, 3)], [(1, "a"), (2, "b"), (3, "c")])
    ranked = R.queries()["recommend_topk"](spark, sf).collect()
    want = [(c, f"{c}," + " ".join(r["product"] for r in sorted(
        (r for r in ranked if r.customer == c), key=lambda r: r["rank"]))) for c in (1, 2, 10)]
    assert [tuple(r) for r in R.queries()["sort_records"](spark, sf).collect()] == want
    assert want == [(1, "1,b c"), (2, "2,a"), (10, "10,b a c")]


@pytest.mark.parametrize("brands", [3, 63, 130])
def test_flags_are_one_number_until_the_last_projection(spark, tmp_path, brands):
    parts = [(k, f"B.{k:03d}") for k in range(brands)] + [(900, None), (1, "B.000")]
    last = brands - 1
    orders = [(1, 7, "1995-01-01"), (1, 7, "1995-01-01"), (2, None, "1995-01-01"),
              (3, 8, "1997-01-01"), (4, 8, "1995-01-01"), (5, 1, "1995-01-01"),
              (5, 2, "1995-01-01"), (None, 3, "1995-01-01"), (None, 4, "1995-01-01")]
    lines = [(1, last), (1, last), (1, 1), (2, 0), (3, 2), (4, 900), (5, 2), (9, 0), (None, 0),
             (1, None)]
    t = S.Tables(spark, _tables(spark, tmp_path, [(1, 1, "X", 1.0)], orders, lines, parts))
    wide = S.brand_flags(t, cutoff=None)
    names = [f"B.{k:03d}" for k in range(brands)]
    assert wide.columns == ["o_orderkey", "customer", *names]
    # the key that two customers share has a 2, as ever
    owned = {1: {0: 1, 1: 1, last: 1}, 2: {0: 1}, 3: {2: 1}, 5: {2: 2}}
    want = sorted(str((k, c, *[owned.get(k, {}).get(b, 0) for b in range(brands)]))
                  for k, c, _ in orders)
    assert sorted(str(tuple(r)) for r in wide.collect()) == want
    assert S.brand_flags(t).count() == 8
    quoted = {f"`{b}`": f"f{k}" for k, b in enumerate(names)}
    flags = wide.select("o_orderkey", *[F.col(q).alias(f) for q, f in quoted.items()])
    assert clean.select_by_regex(flags, "f[0-9]+").columns == list(quoted.values())
    long = features.purchase_long(flags, ["o_orderkey"], list(quoted.values()))
    assert {(r.o_orderkey, r["product"]) for r in long.collect()} == {
        (k, f"f{b}") for k, v in owned.items() for b, n in v.items() if n == 1}
    held = [n for n in _nodes(wide._jdf.queryExecution().sparkPlan())
            if any(x in n.nodeName() for x in ("Aggregate", "Join", "Window", "Exchange", "Sort"))]
    assert held and max(n.output().size() for n in held) <= 6 + -(-brands // 63)


def test_tasks_grow_with_the_lines(spark, tmp_path, monkeypatch):
    """Lines are dealt out by order over as many tasks as they need; AQE doesn't merge those."""
    orders = [(k, k % 5, "1995-01-01") for k in range(40)] + [(3, 9, "1995-01-01"), (3, 3, "1995-01-01"),
                                                              (None, 1, "1995-01-01")]
    lines = [(k % 45, k % 4) for k in range(200)] + [(None, 1), (2, None)]
    parts = [(0, "a"), (1, "b"), (2, None), (3, "c"), (3, "d")]
    t = S.Tables(spark, _tables(spark, tmp_path, [(1, 1, "X", 1.0)], orders, lines, parts))
    names = {k: [b for p, b in parts if p == k] for k in range(4)}
    want = sorted(str((o, c, b)) for o, c, _ in orders for l, p in lines if o is not None and l == o
                  and p is not None for b in names[p])
    plain = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(S, "TASK_LINES", 3)
    tasks = -(-len(lines) // 3)
    assert tasks > plain
    for frame, expected in ((S.purchase_lines(t, S.orders_between(t, None, None)), want),
                            (S.basket(t, S.orders_between(t, None, None)), sorted(set(want)))):
        assert sorted(str(tuple(r)) for r in frame.collect()) == expected
        assert frame.rdd.getNumPartitions() == tasks
    assert S.brand_flags(t, cutoff=None).count() == len(orders)
