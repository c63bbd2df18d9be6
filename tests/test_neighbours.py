from __future__ import annotations

import random

import pytest

from propensa.plans import neighbours as nb


def plain(rows, queries, k):
    out = []
    for q, qx in queries:
        near = sorted((sum((a - b) ** 2 for a, b in zip(qx, x)), key) for key, x in rows if key != q)[:k]
        out += [(q, key, i + 1, d) for i, (d, key) in enumerate(near)]
    return sorted(out)


def got(spark, rows, queries, k, **how):
    schema = "mailchimp_id long, x array<double>"
    found = nb.nearest(spark.createDataFrame(rows, schema), spark.createDataFrame(queries, schema), k, **how)
    return sorted((r["query"], r["key"], r["rank"], r["distance"]) for r in found.collect())


@pytest.mark.parametrize("width", [0.5, 4.0])
def test_neighbours_are_exact(spark, width):
    rng = random.Random(6)
    rows = [(i, [float(rng.randint(0, 9)), float(rng.randint(0, 3)), float(rng.randint(0, 20))]) for i in range(700)]
    rows.append((900, [500.0, -80.0, 3.0]))  # far from all: its buckets hold no other row
    queries = [r for r in rows if r[0] % 50 == 0]
    assert got(spark, rows, queries, 5, width=width) == plain(rows, queries, 5)


def test_a_value_that_most_rows_share_is_dealt_in_parts(spark):
    rows = [(i, [1.0, 2.0]) for i in range(400)] + [(1000 + i, [float(i), 0.0]) for i in range(60)]
    queries = [rows[0], rows[50], rows[410], rows[459]]
    assert got(spark, rows, queries, 7, part_rows=20) == plain(rows, queries, 7)


def test_fewer_rows_than_neighbours(spark):
    rows = [(1, [0.0]), (2, [3.0]), (3, [1.0])]
    assert got(spark, rows, rows, 5) == plain(rows, rows, 5)
    assert got(spark, rows[:1], rows[:1], 5) == []


def test_rows_of_equal_values_are_met_once(spark, monkeypatch):
    """400 queries and 4,000 rows of 4 different values: a query met every row of its value."""
    met = []
    plain_met = nb._met
    monkeypatch.setattr(nb, "_met", lambda *a: met.append(plain_met(*a)) or met[-1])
    rows = [(i, [float(i % 4), 1.0]) for i in range(4000)] + [(5000, [9.0, 1.0])]
    queries = [r for r in rows if r[0] % 10 == 0]
    assert got(spark, rows, queries, 3) == plain(rows, queries, 3)
    assert max(m.count() for m in met) <= 5 * 5 * 4 * nb.TABLES
