from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from propensa.plans import boosting as bo
from propensa.plans import classifiers as cl
from propensa.plans import learning as ln
from propensa.plans import reasons as rs

NAMES = ["a", "b", "c", "d"]
TRIALS = [
    {"max_depth": 2, "learning_rate": 0.5, "n_estimators": 3, "subsample": 1.0, "colsample_bytree": 1.0},
    {"max_depth": 4, "learning_rate": 0.2, "n_estimators": 2, "subsample": 1.0, "colsample_bytree": 0.5},
    {"max_depth": 1, "learning_rate": 0.9, "n_estimators": 4, "subsample": 1.0, "colsample_bytree": 1.0},
]


def data(n=500):
    rng = random.Random(8)
    x = np.array([[rng.randint(0, 6), rng.randint(0, 1), rng.randint(0, 4), rng.randint(0, 9)] for _ in range(n)], float)
    y = np.array([int(a + 3 * b * (c > 1) + rng.random() * 2 > 5) for a, b, c, _ in x])
    return x, y


@pytest.fixture(scope="module")
def rows(spark):
    x, y = data()
    listed = [(i, int(b), a, i % 5 > 0) for i, (a, b) in enumerate(zip(x.tolist(), y.tolist()))]
    return spark.createDataFrame(listed, "mailchimp_id long, label int, x array<double>, learn boolean").repartition(3).cache()


@pytest.fixture(scope="module")
def grown(rows):
    cuts = cl.cut_points(rows)
    return cuts, *bo.grow(cl.binned(rows, cuts), TRIALS, 4, "mailchimp_id")


def plain_trees(x, y, learn, trial, number, cuts):
    """Trees of one trial by trying every cut of every node, and the margins of all rows."""
    margin, trees = np.zeros(len(y)), []
    for r in range(trial["n_estimators"]):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.round((p - y) / bo.UNIT), np.round(p * (1 - p) / bo.UNIT)
        node, tree = np.ones(len(y), int), {}
        for level in range(trial["max_depth"]):
            for k in sorted({k for k in node if k >= 1 << level}):
                here = learn & (node == k)
                score = lambda m: (g[m].sum() * bo.UNIT) ** 2 / (h[m].sum() * bo.UNIT + 1)
                best = None
                for f in bo.drawn_columns(4, trial["colsample_bytree"], 42, number, r):
                    for b, cut in enumerate(cuts[f]):
                        low, high = here & (x[:, f] <= cut), here & (x[:, f] > cut)
                        if min(h[low].sum(), h[high].sum()) * bo.UNIT < 1:
                            continue
                        gain = round(score(low) + score(high) - score(here), bo.DIGITS)
                        if gain > 0 and (best is None or (-gain, f, b) < best):
                            best = (-gain, f, b)
                if best:
                    tree[k] = best[1:]
                    node = np.where(node == k, 2 * k + (x[:, best[1]] > cuts[best[1]][best[2]]), node)
        for k in set(node):
            m = learn & (node == k)
            margin[node == k] += trial["learning_rate"] * -(g[m].sum() * bo.UNIT) / (h[m].sum() * bo.UNIT + 1)
        trees.append(tree)
    return trees, margin


def test_trees_and_margins_are_those_of_trials_grown_alone(rows, grown):
    cuts, trees, state = grown
    x, y = data()
    learn = np.arange(len(y)) % 5 > 0
    margins = np.array([r["margins"] for r in state.orderBy("mailchimp_id").collect()])
    for t, trial in enumerate(TRIALS):
        want, margin = plain_trees(x, y, learn, trial, t, cuts)
        assert [{k: s[:2] for k, s in tree.splits.items()} for tree in trees[t]] == want
        assert np.abs(margins[:, t] - margin).max() < 1e-9


def test_ensembles_score_and_explain(spark, rows, grown):
    cuts, trees, state = grown
    margins = {r["mailchimp_id"]: r["margins"] for r in state.collect()}
    for t, trial in enumerate(TRIALS[:2]):
        explained = bo.as_forest(spark, trees[t], trial, cuts, NAMES)
        held = rows.select("mailchimp_id", "x", explained.trees.scalar().alias("trees"))
        scored = held.select("mailchimp_id", rs.margin(F.col("trees"), F.col("x"), explained.depth).alias("m")).collect()
        assert all(abs(r["m"] - margins[r["mailchimp_id"]][t]) < 1e-9 for r in scored)
        sums = rs.reasons(rows, explained).groupBy("mailchimp_id").agg((F.sum("contribution") + F.first("base")).alias("m")).collect()
        assert all(abs(r["m"] - margins[r["mailchimp_id"]][t]) < 1e-9 for r in sums)


def test_jobs_do_not_grow_with_the_number_of_trials(spark, rows):
    def jobs(trials):
        cuts, tracker = cl.cut_points(rows), spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup(f"grow{len(trials)}", "")
        bo.grow(cl.binned(rows, cuts), trials, 4, "mailchimp_id")
        found = len(tracker.getJobIdsForGroup(f"grow{len(trials)}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found

    one = {**TRIALS[0], "n_estimators": 2}
    assert jobs([one] * 6) == jobs([one])


def test_samples_of_rows_are_repeatable(rows):
    cuts = cl.cut_points(rows)
    trial = [{**TRIALS[0], "subsample": 0.6}]
    first, second = (bo.grow(cl.binned(rows.repartition(n), cuts), trial, 4, "mailchimp_id")[0][0] for n in (2, 7))
    assert [t.splits for t in first] == [t.splits for t in second] and [t.values for t in first] == [t.values for t in second]


def test_a_search_learns(spark):
    x, y = data(600)
    listed = [(i, float(b), Vectors.dense(a), "train" if i % 5 else "val") for i, (a, b) in enumerate(zip(x.tolist(), y.tolist()))]
    table = spark.createDataFrame(listed, ["mailchimp_id", "label", "features", "fold"])
    trials, forests = ln.run_trials_together(table, TRIALS, NAMES)
    found = trials.orderBy("trial_id").collect()
    assert [r["n_estimators"] for r in found] == [3, 2, 4] and len(forests) == 3
    assert max(r["roc_auc"] for r in found) > 0.85 and all(0 <= r["f1"] <= 1 for r in found)
    assert ln.best_params(trials)["max_depth"] in (1, 2, 4)
