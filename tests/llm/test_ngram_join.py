from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from data import changed, frame, odd_rows, prose

from propensa.llm import ngram_join
from propensa.llm.components import components


def plain_sets(rows):
    sets = []
    for row in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1] or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    return sets


def plain_components(rows):
    """(n_shingles, component) of each row by comparing all pairs that share a shingle."""
    sets, ids = plain_sets(rows), [r[0] for r in rows]
    parent = {i: i for i in ids if i is not None}

    def head(i):
        while parent[i] != i:
            i = parent[i]
        return i

    held = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            held[g].append(k)
    for k, s in enumerate(sets):
        for j, common in Counter(j for g in s for j in held[g] if j < k).items():
            if ids[j] is not None and ids[k] is not None and 100 * common >= 80 * (len(s) + len(sets[j]) - common):
                a, b = sorted((head(ids[j]), head(ids[k])))
                parent[b] = a
    return sorted(((i is not None, i or 0, len(s), head(i) if i is not None else None) for i, s in zip(ids, sets, strict=True)), key=str)


def result(df):
    return sorted(((r.doc_id is not None, r.doc_id or 0, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_odd_rows(spark):
    rows = odd_rows()
    assert result(ngram_join.similar_groups(frame(spark, rows, clashes=True))) == plain_components(rows)


@pytest.fixture(scope="module")
def near_rows():
    rows = []
    for base in range(4):
        text = prose(500 + base, 80 + 60 * base)
        rows += [(base * 1000 + i, changed(text, i, i % 9), "en", "a", 1) for i in range(60)]  # similarity from 1 to below 0.8
        rows += [(base * 1000 + 500 + i, text, "en", "a", 1) for i in range(20)]
    passage = prose(9, 70)
    rows += [(9000 + i, prose(3000 + i, 90) + "\n" + passage, "en", "a", 1) for i in range(80)]
    return rows


def test_near_copies_and_a_shared_passage(spark, near_rows):
    assert result(ngram_join.similar_groups(frame(spark, near_rows))) == plain_components(near_rows)


def test_a_bridge_whose_lists_both_components_lead(spark):
    rows = []
    for seed in range(60):
        def words(name, n, seed=seed):
            return [f"{name}{seed}x{i}" for i in range(n)]

        common, a, b = words("c", 93), words("a", 11), words("b", 11)
        four = [common + a, words("v", 11) + common[11:] + a, b + common, b + common[:-11] + words("w", 11)]
        order = random.Random(seed).sample(range(4), 4)
        rows += [(seed * 10 + i, " ".join(four[k]), "en", "a", 1) for i, k in enumerate(order)]  # 89 of 111 shingles link them in a row
    want = plain_components(rows)
    assert {c for *_, c in want} == {seed * 10 for seed in range(60)}
    assert result(ngram_join.similar_groups(frame(spark, rows))) == want


def test_a_coarse_order_gives_the_same_links(spark, near_rows, monkeypatch):
    rows = near_rows[:140] + near_rows[-40:]
    import zstandard

    monkeypatch.setattr(ngram_join, "frequency_order", lambda docs, width: zstandard.compress(b"\1" * (1 << ngram_join.SLOT_BITS)))
    assert result(ngram_join.similar_groups(frame(spark, rows))) == plain_components(rows)


def test_pieces_of_long_texts(monkeypatch):
    texts = [prose(i, n) for i, n in enumerate((1, 3, 5, 6, 40, 41, 97))] + ["", None]
    whole = ngram_join.shingle_sets(texts)
    monkeypatch.setattr(ngram_join, "LONG_WORDS", 7)
    assert [s.tolist() for s in ngram_join.shingle_sets(texts)] == [s.tolist() for s in whole]
    assert [len(s) for s in whole] == [len(s) for s in plain_sets([(0, t) for t in texts])]


def test_empty_table(spark):
    assert ngram_join.similar_groups(frame(spark, odd_rows()).limit(0)).count() == 0


def test_one_of_each(spark):
    rows = odd_rows()
    kept = ngram_join.one_of_each(frame(spark, rows)).collect()
    heads = {c for some, i, n, c in plain_components(rows) if some and c == i}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(heads)
    assert sum(r.doc_id is None for r in kept) == 2


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7), (95, 100), (300, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    want = {i: 1 for i in range(1, 41)} | {90: 90, 95: 90, 100: 90, 200: 200, 300: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
