from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from data import frame, odd_rows, prose
from pyspark.sql import functions as F

from propensa.llm import periodic


def plain_runs(words):
    """Every maximal stretch, by comparing each word with that one period before, for each period."""
    found = {}
    n = len(words)
    for p in range(1, n // 4 + 1):
        start = None
        for i in range(p, n + 1):
            if i < n and words[i] == words[i - p]:
                start = i if start is None else start
            elif start is not None:
                length = i - start + p
                if length >= max(6, 4 * p):
                    found.setdefault((start - p, length), p)
                start = None
    return sorted((s, length, p) for (s, length), p in found.items())


def plain_collapse(words, runs):
    return [w for i, w in enumerate(words) if not any(s + p <= i < s + length for s, length, p in runs)]


def naive_z(s):
    return [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]


def test_z_function():
    rng = random.Random(1)
    for _ in range(400):
        block = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(1, 9))]
        s = (block * 9)[:rng.randint(1, 70)] + [rng.randrange(3) for _ in range(rng.randint(0, 9))]
        assert periodic.z_function(np.array(s)).tolist() == naive_z(s), s


def test_planted_words():
    words = [f"w{i}" for i in range(50)]
    changed = 0
    for doc_id in range(200):
        got = periodic.planted(words, doc_id)
        h = periodic.zlib.crc32(str(doc_id).encode())
        g = h // 10
        a = g % 50
        p = 1 + (50 - a) // (3 + g % 8)
        want = [words[i] if i < a or h % 10 else words[a + (i - a) % p] for i in range(50)]
        assert got == want
        changed += got != words
    assert changed


def strings(seed):
    """Words with runs of many periods, overlapping, cut and embedded."""
    rng = random.Random(seed)
    words = []
    while len(words) < 400:
        block = [rng.choice("abcdefgh"[:rng.choice([1, 2, 3, 8])]) for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33]))]
        words += (block * 8)[:rng.randint(1, len(block) * rng.randint(1, 8))]
    return words[:rng.randint(1, 400)]


def found_alone(documents):
    """Tiles, solutions and stitching without Spark."""
    codes = [np.array([ord(w[0]) for w in words], np.int64) for words in documents]
    pieces = {}
    for nth, octave, boundary, count, first, tile in periodic.explode(codes):
        for p, a, b in periodic.solve(octave, boundary, count, first, tile.astype("<i4")):
            pieces.setdefault((nth, p), []).append((a, b))
    out = [{} for _ in documents]
    for (nth, p), parts in sorted(pieces.items()):
        merged = []
        for a, b in sorted(parts):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        for a, b in merged:
            if b - a + p >= max(6, 4 * p):
                out[nth].setdefault((a - p, b - a + p), p)
    return [sorted((s, length, p) for (s, length), p in runs.items()) for runs in out]


@pytest.mark.parametrize("seed", range(12))
def test_tiles_find_every_run(seed):
    documents = [strings(100 * seed + i) for i in range(25)] + [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 700, ["a", "b"] * 300]
    assert found_alone(documents) == [plain_runs(d) for d in documents]


def expected(rows, plant):
    out = []
    for row in rows:
        words = periodic.WORD.findall(row[1] or "")
        words = periodic.planted(words, row[0]) if plant else words
        runs = plain_runs(words)
        text = " ".join(plain_collapse(words, runs))
        out.append((row[0], len(words), runs, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, plant):
    found = periodic.collapse(periodic.find(frame(spark, rows, clashes=True), plant))
    return sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed_sha256) for r in found.collect()), key=str)


@pytest.mark.parametrize("plant", [False, True])
def test_documents(spark, plant):
    rows = [r for r in odd_rows() if r[0] != 4]
    rows += [(500 + i, " ".join(strings(900 + i)), "en", "a", 1) for i in range(60)] + [(800 + i, prose(i, 90), "en", "a", 1) for i in range(60)]
    assert got(spark, rows, plant) == expected(rows, plant)


def test_a_run_over_a_long_document(spark):
    """Thousands of tiles are joined to one run; a period that the ends of tiles cannot hold is found as well."""
    block = [f"w{i}" for i in range(1_000)]
    rows = [(1, " ".join(["x"] + block * 50 + ["y"]), "en", "a", 1), (2, " ".join(["a"] * 60_000), "en", "a", 1),
            (3, " ".join([*block[:400], *block[:7] * 900, *block]), "en", "a", 1)]
    found = {r.doc_id: r for r in periodic.collapse(periodic.find(frame(spark, rows))).collect()}
    assert [tuple(r) for r in found[1].runs] == [(1, 50_000, 1_000)] and found[1].collapsed == " ".join(["x", *block, "y"])
    assert [tuple(r) for r in found[2].runs] == [(0, 60_000, 1)] and found[2].collapsed == "a"
    assert [tuple(r) for r in found[3].runs] == [(400, 6_307, 7)]


def test_empty_table(spark):
    assert periodic.collapse(periodic.find(frame(spark, odd_rows()).where(F.lit(False)))).count() == 0
