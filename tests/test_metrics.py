from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from propensa.operators import metrics as mx


def table(spark, labels, scores):
    rows = [(int(y), float(s)) for y, s in zip(labels, scores)]
    return mx.predict(spark.createDataFrame(rows, "label int, score double"))


def pair_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def precision_steps(y, s):
    total, area, last = y.sum(), 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        kept = s >= t
        recall = y[kept].sum() / total
        area += (recall - last) * y[kept].mean()
        last = recall
    return area


CASES = {
    "mixed": ([0, 1, 1, 0, 1, 0], [0.1, 0.9, 0.4, 0.4, 0.8, 0.8]),
    "perfect": ([0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9]),
    "reversed": ([1, 1, 0, 0], [0.1, 0.2, 0.8, 0.9]),
    "tied": ([0, 1, 1, 0], [0.5] * 4),
}


@pytest.mark.parametrize("limit", [None, 7])
@pytest.mark.parametrize("case", CASES)
def test_ranking_metrics(spark, case, limit):
    y, s = map(np.array, CASES[case])
    got = mx.ranking_metrics(table(spark, y, s), ranges=limit).first()
    assert math.isclose(got["roc_auc"], pair_auc(y, s))
    assert math.isclose(got["average_precision"], precision_steps(y, s))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=4, max_size=40))
def test_against_brute_force(spark, rows):
    y, s = np.array([r[0] for r in rows]), np.array([r[1] / 7 for r in rows])
    df = table(spark, y, s)
    p = (s > 0.5).astype(int)
    tp, fp, fn = ((y & p).sum(), ((1 - y) & p).sum(), (y & (1 - p)).sum())
    got = mx.classification_metrics(df).first()
    assert math.isclose(got["accuracy"], (y == p).mean())
    assert math.isclose(got["precision"], tp / (tp + fp) if tp + fp else 0)
    assert math.isclose(got["recall"], tp / (tp + fn) if tp + fn else 0)
    assert math.isclose(got["f1_score"], 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0)
    ranks = mx.ranking_metrics(df, ranges=3).first()
    if 0 < y.sum() < len(y):
        assert math.isclose(ranks["roc_auc"], pair_auc(y, s))
        assert math.isclose(ranks["average_precision"], precision_steps(y, s))
    else:
        assert ranks["roc_auc"] is None


def test_one_class(spark):
    df = table(spark, [0, 0], [0.2, 0.7])
    assert mx.ranking_metrics(df).first()["roc_auc"] is None
    assert mx.classification_metrics(df).first()["recall"] == 0.0


@pytest.mark.parametrize("limit", [None, 7])
def test_curves(spark, limit):
    y, s = map(np.array, CASES["mixed"])
    df = table(spark, y, s)
    roc = sorted(tuple(r) for r in mx.roc_curve(df, ranges=limit).collect())
    full = sorted(tuple(r) for r in mx.roc_curve(df, drop_intermediate=False, ranges=limit).collect())
    assert (0.0, 0.0, math.inf) in roc and full[-1] == (1.0, 1.0, 0.1)
    assert set(roc) <= set(full) and len(full) == 5
    for t in (0.9, 0.8, 0.4, 0.1):
        kept = s >= t
        assert ((1 - y)[kept].sum() / 3, y[kept].sum() / 3, t) in full
    pr = [tuple(r) for r in mx.pr_curve(df, ranges=limit).collect()]
    assert (1.0, 0.0, None) in pr and (3 / 5, 1.0, 0.4) in pr and len(pr) == 5


def test_straight_points_are_dropped(spark):
    df = table(spark, [1, 1, 1, 0, 0, 0], [0.9, 0.8, 0.7, 0.6, 0.5, 0.4])
    points = sorted(tuple(r)[:2] for r in mx.roc_curve(df).collect())
    # The corner (0, 1) and the ends stay; (0, 1/3) stays as the first threshold.
    assert points == [(0.0, 0.0), (0.0, 1 / 3), (0.0, 1.0), (1.0, 1.0)]


def test_confusion_has_empty_cells(spark):
    df = table(spark, [1, 1], [0.9, 0.8])
    got = {(r["label"], r["prediction"]): r["count"] for r in mx.confusion_matrix(df).collect()}
    assert got == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 2}


def test_threshold_is_strict(spark):
    assert table(spark, [1], [0.5]).first()["prediction"] == 0


def test_report(spark):
    df = table(spark, [0, 0, 0, 1], [0.1, 0.9, 0.2, 0.8])
    got = {r["class"]: tuple(r)[1:] for r in mx.classification_report(df).collect()}
    assert got["0"] == (1.0, 2 / 3, 0.8, 3)
    assert got["1"] == (0.5, 1.0, 2 / 3, 1)
    assert got["accuracy"] == (None, None, 0.75, 4)
    assert math.isclose(got["macro avg"][0], 0.75) and got["macro avg"][3] == 4
    assert math.isclose(got["weighted avg"][2], (0.8 * 3 + 2 / 3) / 4)


def test_agreement(spark):
    got = mx.agreement_metrics(table(spark, [0, 0, 1, 1], [0.1, 0.9, 0.8, 0.7])).first()
    assert math.isclose(got["kappa"], 0.5) and math.isclose(got["mcc"], 2 / math.sqrt(12))


def test_metrics_by_group(spark):
    df = table(spark, [0, 1, 0, 1], [0.1, 0.9, 0.9, 0.1]).selectExpr("*", "if(score = 0.9 and label = 1 or score = 0.1 and label = 0, 'a', 'b') as g")
    got = {r["g"]: r["roc_auc"] for r in mx.roc_auc(df, by=["g"]).collect()}
    assert got == {"a": 1.0, "b": 0.0}


@pytest.mark.parametrize("measure", [mx.classification_metrics, mx.ranking_metrics, mx.roc_curve, mx.calibration_bins, mx.classification_report])
def test_nulls_are_refused(spark, measure):
    df = spark.createDataFrame([(1, 1, 0.9), (0, 0, 0.1), (None, None, None)], "label int, prediction int, score double")
    with pytest.raises(Exception, match="null among"):
        measure(df).collect()


def test_reports_on_edges(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (0, 0, 0.0), (1, 0, 0.5), (0, 1, 0.55)], "label int, prediction int, score double")
    sweep = {r.threshold: (r.tp, r.fp, r.fn, r.tn) for r in mx.threshold_sweep(df, [0.0, 0.5, 1.0]).collect()}
    assert sweep == {0.0: (2, 1, 0, 1), 0.5: (1, 1, 1, 1), 1.0: (0, 0, 2, 2)}
    assert sorted((r.bin, r.n) for r in mx.calibration_bins(df).collect()) == [(0, 1), (5, 2), (9, 1)]
    assert sum(r.uncertain for r in mx.low_confidence(df).collect()) == 2


def test_group_gaps_hold_the_true_gap(spark):
    """Two groups with a known difference in selection: the intervals hold it, and equal groups' intervals hold 0."""
    rng = np.random.default_rng(4)
    group = rng.integers(0, 3, 3000)
    chosen = (rng.random(3000) < np.where(group == 2, 0.7, 0.4)).astype(int)
    rows = [(i, f"g{g}", int(rng.integers(0, 2)), int(c)) for i, (g, c) in enumerate(zip(group.tolist(), chosen.tolist()))]
    df = spark.createDataFrame(rows, "id long, grp string, label int, prediction int")
    found = {r["grp"]: r for r in mx.group_gaps(df, "grp", "id", replicates=60).collect()}
    whole = chosen.mean()
    for g in range(3):
        row = found[f"g{g}"]
        assert row["n"] == (group == g).sum() and abs(row["selection"] - chosen[group == g].mean()) < 1e-12
        assert abs(row["selection_gap"] - (row["selection"] - whole)) < 1e-12
        assert row["selection_low"] < row["selection_gap"] < row["selection_high"] < row["selection_low"] + 0.12
    assert found["g2"]["selection_low"] > 0.1
    assert found["g0"]["recall_low"] < found["g0"]["recall_high"]


def test_group_gaps_without_positives(spark):
    df = spark.createDataFrame([(1, "a", 0, 1), (2, "b", 1, 1), (3, "b", 0, 0)], "id long, grp string, label int, prediction int")
    found = {r["grp"]: r for r in mx.group_gaps(df, "grp", "id", replicates=8).collect()}
    assert found["a"]["recall"] is None and found["b"]["recall"] == 1.0
