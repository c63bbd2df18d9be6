from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from data import frame, odd_rows
from pyspark.sql import functions as F

from propensa.llm import merkle


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return H(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def plain_levels(leaves: list[str]) -> list[list[str]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i:i + 8]) for i in range(0, len(last), 8)])
    return levels


def plain_path(levels, at):
    """Per level: siblings left and right of the path."""
    out = []
    for level in levels[:-1]:
        run = at // 8 * 8
        out.append((level[run:at], level[at + 1:run + 8]))
        at //= 8
    return out


def plain(rows):
    """What the whole manifest must say, from lists in memory."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, plain_leaf(row, row[1]), row))
    langs = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda e: e[:3])
        trees[lang] = plain_levels([e[2] for e in groups[lang]])
    top = plain_levels([trees[lang][-1][0] for lang in langs])
    out = []
    for nth, lang in enumerate(langs):
        for at, (_, _, leaf, row) in enumerate(groups[lang]):
            path = plain_path(trees[lang], at) + plain_path(top, nth)
            node, text = leaf, row[1]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                changed = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                node = plain_leaf(row, changed)
            for left, right in path:
                node = H(*left, node, *right)
            proof = H(*[s for left, right in path for s in left + right])
            out.append((row[0], leaf, trees[lang][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def got(spark, rows, clashes=False, height=merkle.HEIGHT):
    df = frame(spark, rows, clashes=clashes)
    return sorted(map(tuple, merkle.verify(merkle.manifest(df, height)).collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
@pytest.mark.parametrize("leaves", [1, 2, 7, 8, 9, 63, 64, 65, 500, 512])
def test_addresses_are_a_dense_numbering(levels, leaves):
    leaves = min(leaves, 8 ** (levels - 1))
    widths = [-(-leaves // 8**level) for level in range(levels)]
    places = [merkle.address(leaves, levels, np.full(w, level), np.arange(w)) for level, w in enumerate(widths)]
    assert sorted(np.concatenate(places).tolist()) == list(range(merkle.n_nodes(leaves, levels)))


def test_lower_subtrees_are_contiguous():
    """A complete tree of four levels: the two upper levels first, then each subtree of two levels in one stretch."""
    n = 8**3
    upper = np.concatenate([merkle.address(n, 4, np.array([3]), np.array([0])), merkle.address(n, 4, np.full(8, 2), np.arange(8))])
    assert sorted(upper.tolist()) == list(range(9))
    for subtree in range(64):
        place = np.concatenate([merkle.address(n, 4, np.array([1]), np.array([subtree])),
                                merkle.address(n, 4, np.zeros(8, int), np.arange(8) + 8 * subtree)])
        assert sorted(place.tolist()) == list(range(9 + 9 * subtree, 18 + 9 * subtree))


def test_odd_rows(spark):
    rows = odd_rows()
    assert got(spark, rows, clashes=True) == plain(rows)


def test_many_tiers_and_groups(spark):
    """Blocks of eight leaves: three tiers of blocks, and a top of two tiers."""
    rows = [(i, f"Text {i}", f"l{i % 10}", "s", i) for i in range(400, 0, -1)]
    rows += [(i, "Big", "big", None, 1) for i in range(1000, 1200)]
    rows += [(5000, "X", None, "s", 1)]
    assert got(spark, rows, height=1) == plain(rows)


def test_large_group_of_repeated_rows(spark):
    rows = [(7, "Same", "en", "s", 4)] * 5000 + [(i, "a B", "en", "s", 3) for i in range(20)]
    assert got(spark, rows) == plain(rows)


def test_a_change_is_found_only_where_there_is_one(spark):
    rows = [(i, "Upper" if i % 2 else "lower", "en", "s", 5) for i in range(60)]
    for row in merkle.verify(merkle.manifest(frame(spark, rows))).collect():
        assert row.verified == (zlib.crc32(str(row.id).encode()) % 3 != 0 or row.id % 2 == 0)


def test_empty_table(spark):
    assert got(spark, odd_rows()[:1]) == plain(odd_rows()[:1])
    assert merkle.verify(merkle.manifest(frame(spark, odd_rows()).where(F.lit(False)))).count() == 0
