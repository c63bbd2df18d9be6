from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from propensa.plans import classifiers as cl
from propensa.plans import learning as ln


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 500)
    x = np.stack([rng.normal(y * 1.5, 1 + y), rng.integers(0, 5, 500) + y, rng.normal(0, 1, 500)], axis=1)
    return x, y


@pytest.fixture(scope="module")
def table(spark, rows):
    x, y = rows
    data = [(i, float(b), Vectors.dense(a)) for i, (a, b) in enumerate(zip(x.tolist(), y.tolist()))]
    return spark.createDataFrame(data, ["mailchimp_id", "label", "features"]).repartition(5).cache()


def probabilities(model, table):
    out = model.transform(table).select("mailchimp_id", "prediction", vector_to_array("probability")[1].alias("p")).orderBy("mailchimp_id")
    return [(r["prediction"], r["p"]) for r in out.collect()]


def normal_odds(x, y, quadratic):
    """Log odds from the densities, row by row."""
    parts = []
    means = [x[y == k].mean(axis=0) for k in (0, 1)]
    pooled = sum((x[y == k] - means[k]).T @ (x[y == k] - means[k]) for k in (0, 1)) / (len(x) - 2)
    for k in (0, 1):
        cov = np.cov(x[y == k].T) if quadratic else pooled
        d = x - means[k]
        parts.append(np.log((y == k).sum()) - np.log(np.linalg.det(cov)) / 2 - np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) / 2)
    return parts[1] - parts[0]


@pytest.mark.parametrize("quadratic", [False, True])
def test_discriminant_analysis(table, rows, quadratic):
    odds = normal_odds(*rows, quadratic)
    for (prediction, p), want in zip(probabilities(cl.Discriminant(quadratic).fit(table), table), odds, strict=True):
        assert abs(p - 1 / (1 + math.exp(-want))) < 1e-9 and prediction == float(want > 0)


def test_values_that_do_not_vary_are_left_out(spark, table, rows):
    widened = table.select("mailchimp_id", "label", F.expr("1")).join(table.select("mailchimp_id", "features"), "mailchimp_id")
    doubled = [(r["mailchimp_id"], r["label"], Vectors.dense([*r["features"], 7.0, r["features"][0]])) for r in widened.collect()]
    model = cl.Discriminant().fit(spark.createDataFrame(doubled, ["mailchimp_id", "label", "features"]))
    odds = normal_odds(*rows, False)
    got = probabilities(model, spark.createDataFrame(doubled, ["mailchimp_id", "label", "features"]))
    assert all(abs(p - 1 / (1 + math.exp(-w))) < 1e-6 for (_, p), w in zip(got, odds, strict=True))


def test_one_class_is_an_error(table):
    with pytest.raises(ValueError, match="both classes"):
        cl.Discriminant().fit(table.filter("label = 1"))


def plain_boost(x, y, rounds):
    """Boosted stumps by trying every cut."""
    w, out = np.ones(len(y)), []
    for _ in range(rounds):
        best = None
        for f in range(x.shape[1]):
            for cut in sorted(set(x[:, f]))[:-1]:
                for upper in (1, 0):
                    vote = np.where(x[:, f] > cut, upper, 1 - upper)
                    rank = (round(w[vote != y].sum() / w.sum(), 9), f, cut, -upper)
                    best = min(best, rank) if best else rank
        error = w[np.where(x[:, best[1]] > best[2], -best[3], 1 + best[3]) != y].sum() / w.sum()
        if error >= 0.5:
            break
        vote = np.where(x[:, best[1]] > best[2], -best[3], 1 + best[3])
        out.append((best[1], best[2], -best[3], error))
        w = np.where(vote != y, w * (1 - error) / error, w)
    return out


def test_boosted_stumps(spark):
    rng = random.Random(5)
    x = np.array([[rng.randint(0, 4), rng.randint(0, 1), rng.randint(0, 6)] for _ in range(300)], float)
    y = np.array([int(a + 2 * b + rng.random() * 3 > 4) for a, b, _ in x])
    data = [(i, float(b), Vectors.dense(a)) for i, (a, b) in enumerate(zip(x.tolist(), y.tolist()))]
    table = spark.createDataFrame(data, ["mailchimp_id", "label", "features"])
    model = cl.BoostedStumps(6).fit(table)
    got = [(s["feature"], model.cuts[s["feature"]][s["bin"]], s["upper"], s["error"]) for s in model.stumps]
    want = plain_boost(x, y, 6)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-9 for g, w in zip(got, want, strict=True))
    votes = [sum(math.log((1 - e) / e) * (1 if (row[f] > cut) == bool(up) else -1) for f, cut, up, e in want) for row in x]
    for (prediction, p), v in zip(probabilities(model, table), votes, strict=True):
        assert prediction == float(v > 1e-12) or abs(v) < 1e-9
        assert abs(p - 1 / (1 + math.exp(-v))) < 1e-9


def test_a_perfect_stump_ends_the_rounds(spark):
    table = spark.createDataFrame([(i, float(i > 5), Vectors.dense([i])) for i in range(10)], ["mailchimp_id", "label", "features"])
    model = cl.BoostedStumps(9).fit(table)
    assert len(model.stumps) == 1 and [p for p, _ in probabilities(model, table)] == [0.0] * 6 + [1.0] * 4


def test_they_stand_in_a_comparison(spark, table):
    setup = ln.CompareSetup(folds=2, iterations=3)
    parted = table.withColumn("part", F.expr("cast(mailchimp_id % 3 as int) - 1"))
    board = {r["model"]: r for r in ln.leaderboard(parted, setup, ["lda", "qda", "ada"]).collect()}
    assert set(board) == {"lda", "qda", "ada"} and all(r["accuracy"] > 0.7 and r["parts"] == 2 for r in board.values())


def test_a_round_of_boosting_writes_no_rows(spark, monkeypatch):
    rows = spark.createDataFrame([([i % 5, i % 3], int(i % 5 > 2 or i % 7 == 0)) for i in range(60)] + [(None, 1)], "bins array<int>, label int")
    written, plain = [], cl.stored
    monkeypatch.setattr(cl, "stored", lambda df: written.append(df) or plain(df))
    stumps = cl.boost(rows, 4)
    assert len(written) == 1 and len(stumps) == 4  # the weights were written anew in each round
    weights = [1.0] * 60
    for s in stumps:
        votes = [s["upper"] if (i % 5, i % 3)[s["feature"]] > s["bin"] else 1 - s["upper"] for i in range(60)]
        wrong = [v != int(i % 5 > 2 or i % 7 == 0) for i, v in enumerate(votes)]
        assert abs(sum(w for w, bad in zip(weights, wrong) if bad) / sum(weights) - s["error"]) < 1e-9
        weights = [w * (1 - s["error"]) / s["error"] if bad else w for w, bad in zip(weights, wrong)]


def test_linear_fits_of_few_rows_are_one_task(spark, monkeypatch):
    rows = [(i, i % 4, float(i % 3 == 0), Vectors.dense([float(i % 3), float(i % 5)])) for i in range(80)]
    table = spark.createDataFrame(rows, ["mailchimp_id", "part", "label", "features"])
    tasks = []

    class Fit:
        def __init__(self, plain):
            self.plain = plain

        def fit(self, train):
            tasks.append(train.rdd.getNumPartitions())
            return self.plain.fit(train)

    plain = ln._classifiers
    monkeypatch.setattr(ln, "_classifiers", lambda *a: {k: Fit(v) for k, v in plain(*a).items()})
    board = ln.leaderboard(table.repartition(6), ln.CompareSetup(folds=3, iterations=2), ["lr", "svm"]).collect()
    assert tasks == [1] * 6 and sorted(r["model"] for r in board) == ["lr", "svm"]
