from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from data import frame, odd_rows, prose

from propensa.llm import toxicity
from propensa.llm.catalog import op4_toxicity
from propensa.llm.tables import read


def test_features_of_odd_texts():
    weights = toxicity._Weights({"grob": 3.5, "grober$": 4.0})
    for text in ["", " ", "A", "!!!", "\0", "you idiot", "YOU id1ot GROBer grobheit sooo", "é" * 9, prose(1, 3000)]:
        row = toxicity.features(text, weights)
        assert len(row) == len(toxicity.FEATURES) and np.isfinite(row).all()
    named = dict(zip(toxicity.FEATURES, toxicity.features("you idiot GROBer grobheit st@pid id1ot sooo", weights), strict=True))
    assert named["insult_count"] == 1 and named["strong_count"] == 2 and named["aimed"] > 0
    assert named["disguised"] > 0 and named["disguised_hits"] == 1 and named["stretched"] > 0 and named["heaviest"] == 4.0


def test_isotonic_is_monotone_and_pools_ties():
    rng = np.random.default_rng(1)
    margin = np.round(rng.normal(size=500), 1)
    y = (rng.random(500) < 1 / (1 + np.exp(-2 * margin))).astype(float)
    at, level = toxicity.isotonic(margin, y)
    assert (np.diff(level) >= 0).all() and (np.diff(at) >= 0).all()
    fitted = np.interp(margin, at, level)
    assert abs(fitted.mean() - y.mean()) < 1e-9
    # No monotone step function of the margin is closer; compare with a plain pooling.
    values = sorted(set(margin))
    blocks = [[[v], y[margin == v].mean(), (margin == v).sum()] for v in values]
    i = 0
    while i + 1 < len(blocks):
        if blocks[i][1] > blocks[i + 1][1]:
            a, b = blocks[i], blocks.pop(i + 1)
            blocks[i] = [a[0] + b[0], (a[1] * a[2] + b[1] * b[2]) / (a[2] + b[2]), a[2] + b[2]]
            i = max(0, i - 1)
        else:
            i += 1
    plain = {v: level for vs, level, _ in blocks for v in vs}
    assert np.allclose(fitted, [plain[m] for m in margin])


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = toxicity.Trees().fit(x[:1500], y[:1500])
    assert ((model.margin(x[1500:]) > 0) == y[1500:]).mean() > 0.93


def auc(truth, score):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    pos = np.array(truth) == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_rows_of_the_given_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in read(spark, sf_dir, "labels").collect()}
    rows = op4_toxicity(spark, sf_dir).collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)
    assert auc([truth[r.doc_id] for r in held], np.array([r.score for r in held])) > 0.95
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    # Calibrated: the mean score is near the share of toxic rows.
    assert np.mean([r.score for r in held]) == pytest.approx(np.mean([truth[r.doc_id] for r in held]), abs=0.03)


def test_odd_rows_and_labels(spark):
    rows = odd_rows()
    labels = [(i, random.Random(i).randint(0, 1)) for i in range(1, 15)] + [(100 + i, i % 2) for i in range(20)] + [(None, 1), (5, 1), (6, None), (999, 0)]
    got = toxicity.score(frame(spark, rows, clashes=True), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in rows)
    assert all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1 and len({r.score for r in got if r.doc_id == 5}) == 1


@pytest.mark.parametrize(("labels", "level"), [([], 0.0), ([(100, 1), (101, 1), (102, 1), (103, 1)], None)])
def test_labels_of_one_kind(spark, labels, level):
    got = toxicity.score(frame(spark, odd_rows()), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len({r.score for r in got}) == 1
    assert level is None or got[0].score == level


def test_empty_table(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.score(frame(spark, odd_rows()).limit(0), labels).count() == 0
