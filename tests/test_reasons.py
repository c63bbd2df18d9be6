from __future__ import annotations

import random
from types import SimpleNamespace

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from propensa.plans import reasons as rs
from propensa.plans.learning import lead_features
from propensa.queries import models
from propensa.queries import reasons as queries

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = [(i, float(x[0] + x[1] * x[2] > 6), Vectors.dense(x)) for i in range(400)
            for x in [[rng.randint(0, 9), rng.randint(0, 3), rng.randint(0, 4)]]]
    return spark.createDataFrame(
        rows, ["mailchimp_id", "label", "features"]).cache()


@pytest.fixture(scope="module")
def model(table):
    return GBTClassifier(maxIter=6, maxDepth=4, stepSize=0.3, seed=1).fit(table)


def test_contributions_add_up_to_the_margin(spark, table, model):
    explained = rs.fitted_forest(model, NAMES, spark)
    rows = rs.reasons(rs.with_values(table, "mailchimp_id"), explained)
    sums = {r["mailchimp_id"]: r for r in rows.groupBy("mailchimp_id").agg(
        F.sum("contribution").alias("s"), F.first("base").alias("base"), F.first("margin").alias("margin")).collect()}
    raw = model.transform(table).select("mailchimp_id", vector_to_array("rawPrediction")[1].alias("m")).collect()
    assert len(sums) == len(raw)
    for r in raw:
        assert abs(sums[r["mailchimp_id"]]["s"] + sums[r["mailchimp_id"]]["base"] - r["m"]) < 1e-9
        assert abs(sums[r["mailchimp_id"]]["margin"] - r["m"]) < 1e-9


def test_ranks_and_values(spark, table, model):
    explained = rs.fitted_forest(model, NAMES, spark)
    leads = rs.with_values(table, "mailchimp_id")
    x = {r["mailchimp_id"]: r["x"] for r in leads.collect()}
    for r in rs.reasons(leads, explained, top=2).collect():
        assert r["rank"] <= 2 and r["value"] == x[r["mailchimp_id"]][NAMES.index(r["feature"])]


def test_categories_go_left(spark):
    nodes = [(0, 1.0, 0, 0.0, 1, 2, 0, None, [1.0, 3.0]), (0, 1.0, 1, 5.0, -1, -1, -1, None, None), (0, 1.0, 2, -5.0, -1, -1, -1, None, None)]
    explained = rs.forest(spark.createDataFrame(nodes, rs.NODES), 1, ["a"])
    leads = spark.createDataFrame([(i, [float(i)]) for i in range(4)], "mailchimp_id long, x array<double>")
    assert {r["mailchimp_id"]: r["contribution"] for r in rs.reasons(leads, explained).collect()} == {0: -5.0, 1: 5.0, 2: -5.0, 3: 5.0}


def test_dependence_is_the_mean_margin(spark, table, model):
    explained = rs.fitted_forest(model, NAMES, spark)
    leads = rs.with_values(table, "mailchimp_id")
    grid = rs.quantile_grid(leads, explained, ["b"], 4)
    got = {r["value"]: r["mean_margin"] for r in rs.partial_dependence(leads, explained, grid).collect()}
    rows = table.select("features").collect()
    for value in grid["b"]:
        changed = spark.createDataFrame([(Vectors.dense([r["features"][0], value, r["features"][2]]),) for r in rows], ["features"])
        mean = model.transform(changed).agg(F.avg(vector_to_array("rawPrediction")[1])).first()[0]
        assert abs(got[value] - mean) < 1e-9


def test_a_lead_that_nothing_splits_has_no_rows(spark):
    explained = rs.forest(spark.createDataFrame([(0, 1.0, 0, 2.0, -1, -1, -1, None, None)], rs.NODES), 1, ["a"])
    leads = spark.createDataFrame([(1, [0.0])], "mailchimp_id long, x array<double>")
    assert rs.reasons(leads, explained).count() == 0


def test_what_is_missing_goes_right_and_a_repeated_lead_counts_twice(spark):
    nodes = [(0, 0.5, 0, 0.0, 1, 2, 1, 2.0, None), (0, 0.5, 1, 6.0, -1, -1, -1, None, None), (0, 0.5, 2, -4.0, -1, -1, -1, None, None)]
    explained = rs.forest(spark.createDataFrame(nodes, rs.NODES), 1, ["a", "b"])
    leads = spark.createDataFrame([(1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [0.0, None]), (3, [0.0]), (4, None)], "mailchimp_id long, x array<double>")
    found = {r["mailchimp_id"]: (r["feature"], r["value"], r["contribution"], r["margin"]) for r in rs.reasons(leads, explained).collect()}
    assert found == {1: ("b", 1.0, 6.0, 6.0), 2: ("b", None, -2.0, -2.0), 3: ("b", None, -2.0, -2.0), 4: ("b", None, -2.0, -2.0)}
    means = rs.partial_dependence(leads, explained, {"b": [1.0, 3.0]}).collect()
    assert {r["value"]: r["mean_margin"] for r in means} == {1.0: (3 * 3.0 - 2 * 2.0) / 5, 3.0: -2.0}  # leads 3 and 4 have no such value to set


def test_reasons_shuffle_one_row_a_lead(spark, table, model):
    explained = rs.fitted_forest(model, NAMES, spark)
    plan = rs.reasons(rs.with_values(table, "mailchimp_id"), explained)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange")  # dealt before a lead's features are rows


def test_the_models_dependence_is_told_for_every_numeric_input(spark, monkeypatch):
    names = lead_features(["tag_a"])
    rng = random.Random(5)
    x = [[float(rng.randint(0, 3 + k % 4)) for k in range(len(names))] for _ in range(60)]
    y = [float(v[0] + v[2] * v[3] + v[-1] > 5 + (v[1] == 2)) for v in x]
    table = spark.createDataFrame([(i, label, Vectors.dense(v)) for i, (v, label) in enumerate(zip(x, y))], ["mailchimp_id", "label", "features"])
    fitted = GBTClassifier(maxIter=4, maxDepth=3, stepSize=0.3, seed=1).fit(table)
    monkeypatch.setattr(models, "_model", lambda *_: SimpleNamespace(pipeline=SimpleNamespace(stages=[fitted]), features=names))
    monkeypatch.setattr(models, "_featurized", lambda *_: (None, table))
    rows = queries.model_dependence(spark, "").collect()
    assert len({(r["feature"], r["value"]) for r in rows}) == len(rows)
    assert {r["feature"] for r in rows} == set(names) - {"country_code"}
    for place, name in enumerate(names):
        of_name = {r["value"]: r["mean_margin"] for r in rows if r["feature"] == name}
        if name == "country_code":
            continue
        values = sorted(v[place] for v in x)
        assert sorted(of_name) == sorted({values[max(0, -(-len(x) * i // 4) - 1)] for i in range(5)})
        sets = [(value, Vectors.dense([*v[:place], value, *v[place + 1:]])) for value in of_name for v in x]
        means = fitted.transform(spark.createDataFrame(sets, ["value", "features"])).groupBy("value").agg(
            F.avg(vector_to_array("rawPrediction")[1]).alias("m")).collect()
        assert all(abs(of_name[r["value"]] - r["m"]) < 1e-9 for r in means)


def test_dependence_of_an_input_split_on_twice_and_by_category(spark):
    # a <= 2: (a <= 0: 1, else (b in {1, 3}: 2, else 4)), else (a <= 5: 8, else 16)
    nodes = [(0, 0.0, 1, 2, 0, 2.0, None), (1, 0.0, 3, 4, 0, 0.0, None), (2, 0.0, 5, 6, 0, 5.0, None), (3, 1.0, -1, -1, -1, None, None),
             (4, 0.0, 7, 8, 1, None, [1.0, 3.0]), (5, 8.0, -1, -1, -1, None, None), (6, 16.0, -1, -1, -1, None, None),
             (7, 2.0, -1, -1, -1, None, None), (8, 4.0, -1, -1, -1, None, None)]
    trees = [(0, 1.0, *n) for n in nodes] + [(1, 0.5, 0, 32.0, -1, -1, -1, None, None)]
    explained = rs.forest(spark.createDataFrame(trees, rs.NODES), 3, ["a", "b", "c"])
    leads = spark.createDataFrame([(i, [a, b, 0.0]) for i, (a, b) in enumerate([(1.0, 1.0), (1.0, 2.0), (4.0, 3.0), (9.0, 1.0)])],
                                  "mailchimp_id long, x array<double>")
    found = rs.partial_dependence(leads, explained, {"a": [0.0, 1.0, 4.0, 9.0], "b": [1.0, 2.0], "c": [7.0]}).collect()
    assert {(r["feature"], r["value"]): r["mean_margin"] - 16.0 for r in found} == {
        ("a", 0.0): 1.0, ("a", 1.0): 2.5, ("a", 4.0): 8.0, ("a", 9.0): 16.0,
        ("b", 1.0): (2 + 2 + 8 + 16) / 4, ("b", 2.0): (4 + 4 + 8 + 16) / 4, ("c", 7.0): (2 + 4 + 8 + 16) / 4}
