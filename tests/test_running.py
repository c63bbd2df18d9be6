from __future__ import annotations

import random

import pytest

from propensa.operators.running import Running, running_totals
from propensa.operators.summaries import group_quantiles, pareto, target_distribution

WHAT = Running(sums={"cum": "x"}, totals={"all": "x"}, following={"next": "x"})


def brute(rows, descending):
    out = []
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: r[1], reverse=descending)
        total, cum = sum(r[2] for r in mine), 0
        for i, r in enumerate(mine):
            cum += r[2]
            out.append((*r, cum, total, mine[i + 1][2] if i + 1 < len(mine) else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("limit", [None, 7])
def test_equal_to_brute_force(spark, descending, limit):
    random.seed(3)
    # Group 0 holds most of the rows.
    rows = [(0 if i % 3 else i % 5, i * 7919 % 1009, random.randrange(9)) for i in range(600)]
    rows = list({(g, v): (g, v, x) for g, v, x in rows}.values())
    df = spark.createDataFrame(rows, "g int, v int, x int").repartition(5)
    got = running_totals(df, ["v"], WHAT, ["g"], descending, ranges=limit)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, descending)


@pytest.mark.parametrize("limit", [None, 7])
def test_two_order_columns_without_groups(spark, limit):
    rows = [(i % 3, f"k{i:03d}", 1) for i in range(100)]
    df = spark.createDataFrame(rows, "a int, b string, x int")
    got = running_totals(df, ["a", "b"], Running(sums={"n": "x"}), ranges=limit).collect()
    expected = {r: i + 1 for i, r in enumerate(sorted(rows))}
    assert {tuple(r)[:3]: r["n"] for r in got} == expected


def test_empty_table(spark):
    df = spark.createDataFrame([], "g int, v int, x int")
    assert running_totals(df, ["v"], WHAT, ["g"]).count() == 0


@pytest.mark.parametrize("limit", [None, 7])
def test_pareto_ties_shares_and_nulls(spark, limit):
    rows = [("b", 1), ("a", 1), ("c", 1), ("c", 1), ("c", 0), ("d", 0), (None, 1), ("e", 1), ("f", 0)]
    df = spark.createDataFrame(rows, "k string, made_purchase int")
    got = {r["k"]: tuple(r)[1:] for r in pareto(df, "k", ranges=limit).collect()}
    assert got["c"] == (2, 2 / 3, 2 / 5, 2 / 5)
    assert got["a"] == (1, 1.0, 1 / 5, 3 / 5)
    assert got["b"] == (1, 1.0, 1 / 5, 4 / 5)
    assert got["f"][3] == 1.0 and None not in got
    kept = pareto(df, "k", min_sales=1, ranges=limit).collect()
    assert [tuple(r) for r in kept] == [("c", 2, 2 / 3, 2 / 5, 2 / 5)]


@pytest.mark.parametrize("limit", [None, 7])
def test_quantiles_interpolate(spark, limit):
    rows = [(0, i) for i in range(10)] + [(1, 5), (2, None), (3, 1), (3, 1), (3, 4)]
    df = spark.createDataFrame(rows, "g int, v int")
    got = {(r["g"], r["quantile"]): r["value"] for r in group_quantiles(df, "g", "v", ranges=limit).collect()}
    assert [round(got[0, q], 9) for q in (0.1, 0.5, 0.9)] == [0.9, 4.5, 8.1]
    assert got[1, 0.1] == got[1, 0.9] == 5.0
    assert got[3, 0.5] == 1.0 and round(got[3, 0.9], 9) == 3.4
    assert not any(g == 2 for g, _ in got)


def test_approximate_quantiles_are_values(spark):
    df = spark.createDataFrame([(0, i) for i in range(10)], "g int, v int")
    got = [r["value"] for r in group_quantiles(df, "g", "v", approximate=True).orderBy("quantile").collect()]
    assert got == [0.0, 4.0, 8.0]


def test_target_distribution(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,), (None,)], "made_purchase int")
    assert sorted(tuple(r) for r in target_distribution(df).collect()) == [(0, 3, 0.75), (1, 1, 0.25)]
