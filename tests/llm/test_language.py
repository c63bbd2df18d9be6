from __future__ import annotations

import zlib

import numpy as np
from data import frame, odd_rows, prose

from propensa.llm import language
from propensa.llm.catalog import op7_language_id
from propensa.llm.tables import read


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    net = language.Network(["a", "b", "c"], hidden=3).start()
    block, inside, _ = language.stretches([bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (5, 9, 3)])
    block, inside, truth = block[:10], inside[:10], np.array([0, 2, 1])
    _, grads = net.gradients(block, inside, truth)
    for name in net.w:
        for at in [tuple(rng.integers(0, s) for s in net.w[name].shape) for _ in range(4)]:
            if name in "gx":
                at = (at[0], block[0, 0], at[2])
            old, step, losses = net.w[name][at], 1e-2, []
            for sign in (1, -1):
                net.w[name][at] = old + sign * step
                losses.append(net.gradients(block, inside, truth)[0])
            net.w[name][at] = old
            assert abs((losses[0] - losses[1]) / (2 * step) - grads[name][at]) < 2e-3


def test_every_byte_lies_in_one_stretch():
    texts = [b"", b"x", b"y" * language.STRETCH, bytes(range(256)) * 3 + b"z"]
    block, inside, owner = language.stretches(texts)
    for i, text in enumerate(texts):
        own = owner == i
        assert inside[:, own].sum() == len(text)
        assert block[:, own].T.tobytes()[: len(text)] == text


def test_reading_together_equals_reading_alone():
    net = language.Network(["a", "b"]).start()
    texts = [prose(i, n).encode() for i, n in enumerate((1, 30, 200, 900))]
    together = net.read(texts)
    assert np.allclose(together, np.concatenate([net.read([t]) for t in texts]), atol=1e-5)
    assert np.allclose(together.sum(axis=1), 1, atol=1e-4)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in read(spark, sf_dir, "documents").collect()}
    rows = op7_language_id(spark, sf_dir).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    rows = odd_rows()
    docs = frame(spark, rows, clashes=True)
    got = language.predict(docs, language.fit(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        lettered = any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred in {"en", "de", "fr"}) if lettered else (r.lang_pred, r.score) == ("und", 0.0)
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == 5}) == 1


def test_nothing_to_learn_from(spark):
    docs = frame(spark, odd_rows())
    empty = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.predict(docs, empty).collect()} == {"und"}
    assert language.predict(docs.limit(0), empty).count() == 0


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "STEPS", 3)
    monkeypatch.setattr(language, "SAMPLE_ROWS", 50)
    rows = [(k * 1000 + i, prose(k * 1000 + i, 5), f"l{k:02}", "a", 1) for k in range(70) for i in range(4 if k else 400)]
    assert language.fit(frame(spark, rows)).languages == [f"l{k:02}" for k in range(70)]
