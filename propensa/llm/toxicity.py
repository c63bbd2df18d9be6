"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of lexicon words, their nearness to second
persons, capitals, punctuation and obfuscation rates. The lexicon is a short
list of insults and a learned one: word beginnings and whole words that stand
more often in labelled toxic texts than in others, weighted by the logarithm of the ratio.

Learning uses a bounded, stated sample of labelled rows that are not held out.
Their hash splits them: one half teaches the lexicon, the other the trees, so that the trees
do not see words that their own rows put into the lexicon. Two-fold predictions of
that other half are calibrated by isotonic regression. Counts of words are Spark aggregates;
trees are fitted on a table of numbers and applied to all rows on the executors.

Defined results: a null text is an empty text and gets the score of one;
repeated rows get equal scores; several labels of one ``doc_id`` count as the
largest; with labels of one kind only (or none) every score is their mean (or 0).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensa.llm.language import held_out
from propensa.llm.ngram_join import text_slices
from propensa.llm.tables import releasing, ship
from propensa.session import stored

SAMPLE_TEXTS = 12_000  # bound of the rows that teach the lexicon
SAMPLE_ROWS = 60_000  # bound of the rows that teach trees and calibration
LEXICON = 4_000  # bound of the learned entries
STEMS = range(3, 9)  # lengths of word beginnings
LEAST_COUNT = 6  # occurrences of an entry in toxic texts
NEAR = 5  # words between an insult and a second person
KNOWN_WORDS = 400_000
# Insults, and second persons, of some languages.
INSULTS = frozenset("""
    bastard clown coward creep cretin disgusting dumb dumbass fool freak garbage idiot imbecile jerk loser lunatic moron
    pathetic pig rat retard scum shit slut stupid trash ugly vermin whore worthless abruti connard crétin débile imbécile
    ordure salaud salope arschloch blödmann depp dreck dumm idiotin trottel wichser basura estúpido gilipollas idiota
    imbécil inútil mierda payaso tonto""".split())
SECOND_PERSONS = frozenset("""
    you your yours yourself yourselves thou thee thy tu te toi ton ta tes vous votre vos du dich dir dein deine deiner euch
    euer ihr tú ti usted ustedes vosotros vuestro tus""".split())
# Signs written for letters.
SIGNS = str.maketrans("013457@$!+", "oieastasit")
FEATURES = ["insults", "strong", "medium", "weak", "weight", "heaviest", "insult_count", "strong_count", "second", "aimed", "upper",
            "shouted", "exclaimed", "asked", "punctuation", "runs", "disguised", "disguised_hits", "stretched", "words"]
_WORD = re.compile(r"[^\W\d_]+")
_DISGUISED = re.compile(r"[^\W\d_]+[0-9@$!*+][0-9@$!*+]*[^\W\d_][\w@$!*+]*")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
_RUN = re.compile(r"[!?]{2,}")


def entries(word: str) -> list[str]:
    """A word's lexicon entries: its beginnings, and itself with an end mark."""
    return [word[:k] for k in STEMS if len(word) > k] + [f"{word}$"]


class _Weights(dict):
    """Weight of a word: the largest of its entries. Remembers words, anew when too many are known."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = weight = max((self.lexicon.get(e, 0.0) for e in entries(word)), default=0.0)
        return weight


def features(text: str, weights: _Weights) -> list[float]:
    words = _WORD.findall(text.lower())
    n = max(1, len(words))
    heavy = np.fromiter((weights[w] for w in words), np.float64, len(words)) if words else np.zeros(1)
    insult_at = [i for i, w in enumerate(words) if w in INSULTS] if not INSULTS.isdisjoint(words) else []
    second_at = np.array([i for i, w in enumerate(words) if w in SECOND_PERSONS])
    hits = np.union1d(insult_at, np.flatnonzero(heavy >= 3.0)) if words else np.zeros(0)
    if len(second_at) and len(hits):
        to = np.searchsorted(second_at, hits)
        gap = np.minimum(np.abs(hits - second_at[np.minimum(to, len(second_at) - 1)]), np.abs(hits - second_at[np.maximum(to - 1, 0)]))
        aimed = float((gap <= NEAR).sum())
    else:
        aimed = 0.0
    chars = max(1, len(text))
    letters = max(1, sum(map(len, words)))
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    tokens = text.split()
    disguised = _DISGUISED.findall(text)
    plain = [d.translate(SIGNS).lower() for d in disguised]
    return [
        100 * len(insult_at) / n, 100 * float((heavy >= 3.0).sum()) / n, 100 * float((heavy >= 2.0).sum()) / n,
        100 * float((heavy >= 1.0).sum()) / n, 100 * float(heavy.sum()) / n, float(heavy.max()),
        len(insult_at), float((heavy >= 3.0).sum()), 100 * len(second_at) / n, 100 * aimed / n, upper / letters,
        sum(t.isupper() and len(t) > 2 for t in tokens) / max(1, len(tokens)), 100 * text.count("!") / chars,
        100 * text.count("?") / chars, 100 * sum(map(text.count, ".,;:")) / chars, 100 * len(_RUN.findall(text)) / n,
        100 * len(disguised) / n, float(sum(p in INSULTS or weights[p] >= 3.0 for p in plain)),
        100 * len(_STRETCHED.findall(text)) / n, math.log1p(len(words)),
    ]


@dataclass
class Trees:
    """Boosted regression trees on logistic loss over binned features.

    A tree is (feature, bin, left, right, value) arrays; rows with a bin up to
    the node's go left, and a node without children holds a value.
    """

    depth: int = 4
    rounds: int = 80
    rate: float = 0.15
    least: int = 8
    bins: int = 48
    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, ...]] = field(default_factory=list)
    start: float = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins)[1:-1])) for c in x.T]
        binned, mean = self._binned(x), float(y.mean())
        self.start = math.log((mean + 1e-6) / (1 - mean + 1e-6))
        margin = np.full(len(y), self.start)
        self.trees = []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(binned, y - p, np.maximum(1e-6, p * (1 - p)))
            self.trees.append(tree)
            margin += self._leaf_values(tree, binned)
        return self

    def _grow(self, binned: np.ndarray, slope: np.ndarray, curve: np.ndarray) -> tuple[np.ndarray, ...]:
        nodes: list[list[float]] = []
        todo = [(np.arange(len(slope)), 0, -1, 2)]
        while todo:
            rows, level, parent, side = todo.pop()
            g, h = slope[rows].sum(), curve[rows].sum()
            me = len(nodes)
            nodes.append([-1, 0, -1, -1, self.rate * g / (h + 1.0)])
            if parent >= 0:
                nodes[parent][side] = me
            if level == self.depth or len(rows) < 2 * self.least:
                continue
            best = (1e-4, -1, 0)
            for j in range(binned.shape[1]):
                size = len(self.edges[j]) + 1
                column = binned[rows, j]
                gs, hs, ns = (np.bincount(column, w, size).cumsum()[:-1] for w in (slope[rows], curve[rows], None))
                ok = (ns >= self.least) & (len(rows) - ns >= self.least)
                gain = np.where(ok, gs ** 2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g * g / (h + 1), 0)
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), j, int(gain.argmax()))
            if best[1] >= 0:
                left = binned[rows, best[1]] <= best[2]
                nodes[me][:2] = best[1:]
                todo += [(rows[~left], level + 1, me, 3), (rows[left], level + 1, me, 2)]
        table = np.array(nodes)
        return (*(table[:, i].astype(int) for i in range(4)), table[:, 4])

    @staticmethod
    def _leaf_values(tree: tuple[np.ndarray, ...], binned: np.ndarray) -> np.ndarray:
        feature, cut, left, right, value = tree
        at = np.zeros(len(binned), int)
        while (inner := feature[at] >= 0).any():
            rows = np.flatnonzero(inner)
            node = at[rows]
            at[rows] = np.where(binned[rows, feature[node]] <= cut[node], left[node], right[node])
        return value[at]

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        return self.start + sum((self._leaf_values(t, binned) for t in self.trees), np.zeros(len(x)))


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Margins and non-decreasing probabilities at them, by pooling adjacent violators."""
    values, place, counts = np.unique(margin, return_inverse=True, return_counts=True)
    sums = np.bincount(place, y, len(values))
    blocks: list[list[float]] = []  # sum, count, lowest and highest margin
    for s, c, m in zip(sums.tolist(), counts.tolist(), values.tolist(), strict=True):
        blocks.append([s, c, m, m])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, c, _, high = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + c, blocks[-1][2], high]
    return np.array([b[i] for b in blocks for i in (2, 3)]), np.repeat([b[0] / b[1] for b in blocks], 2)


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: Trees | None
    margins: np.ndarray
    levels: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.levels[0])
        return np.interp(self.trees.margin(x), self.margins, self.levels)


def _labelled(labels: DataFrame) -> DataFrame:
    """Labels to learn from: doc_id, toxic, half (0 or 1), draw (a hash)."""
    kept = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    kept = kept.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    return kept.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)).cast("int")).withColumn(
        "draw", F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1 << 30)))


def _drawn(rows: DataFrame, n: int, most: int) -> DataFrame:
    """About ``most`` of the ``n`` rows at most, by their hash; all of them if there are no more."""
    return rows.where(F.col("draw") < int((1 << 30) * min(1.0, most / max(1, n))))


def learn_lexicon(docs: DataFrame, labelled: DataFrame) -> dict[str, float]:
    """Entry to weight, from half 0 of the labelled rows: as many toxic rows as others, ``SAMPLE_TEXTS`` at most."""
    half = labelled.where("half = 0")
    counts = {r.toxic: r["count"] for r in half.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return {}
    sample = None
    for kind, n in sorted(counts.items()):
        part = _drawn(half.where(F.col("toxic") == kind), n, SAMPLE_TEXTS // 2)
        sample = part if sample is None else sample.unionByName(part)
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(stored(sample.select("doc_id", "toxic"))), "doc_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            found: dict[str, list[int]] = {}
            for text, toxic in zip(texts, batch.column("toxic").to_pylist(), strict=True):
                for word, n in Counter(_WORD.findall((text or "").lower())).items():
                    for e in entries(word):
                        found.setdefault(e, [0, 0])[toxic] += n
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found)), *(pa.array([v[i] for v in found.values()], pa.int64()) for i in (0, 1))], names=["entry", "other", "toxic"])

    table = rows.select("text", "toxic").mapInArrow(releasing(count), "entry string, other long, toxic long")
    table = stored(table.groupBy("entry").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")))
    whole = table.where(F.col("entry").endswith("$")).agg(F.sum("other"), F.sum("toxic")).first()
    others, toxics = (max(1, v or 0) for v in whole)
    weight = F.log((F.col("toxic") + 0.5) / toxics) - F.log((F.col("other") + 0.5) / others)
    best = table.withColumn("weight", weight).where((F.col("weight") >= 1.0) & (F.col("toxic") >= LEAST_COUNT))
    best = best.orderBy(F.desc(F.col("weight") * F.log(F.col("toxic") + 1.0)), "entry").limit(LEXICON)
    return {r.entry: r.weight for r in best.select("entry", "weight").collect()}


def feature_table(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """(doc_id, x) of every row, ``x`` as in ``FEATURES``. Written once: it is read to learn and to score."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _Weights(lexicon)
        for batch, texts in text_slices(batches):
            rows = [features(t or "", weights) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return stored(docs.select("doc_id", "text").mapInArrow(releasing(describe), docs.select("doc_id").schema.add("x", T.ArrayType(T.DoubleType()))))


def learn(table: DataFrame, labelled: DataFrame, lexicon: dict[str, float]) -> Model:
    """Trees and calibration from half 1 of the labelled rows, ``SAMPLE_ROWS`` at most."""
    half = labelled.where("half = 1")
    sample = _drawn(half, half.count(), SAMPLE_ROWS)
    rows = table.select(F.col("doc_id").cast("long"), "x").join(sample, "doc_id").orderBy("draw", "doc_id").limit(SAMPLE_ROWS).select("toxic", "x").collect()
    y = np.array([r.toxic for r in rows], float)
    if len(set(y.tolist())) < 2:
        return Model(lexicon, None, np.zeros(1), np.array([float(y.mean()) if len(y) else 0.0]))
    x = np.array([r.x for r in rows])
    fold = np.arange(len(y)) % 2
    margin = np.zeros(len(y))
    for k in (0, 1):
        margin[fold == k] = Trees().fit(x[fold != k], y[fold != k]).margin(x[fold == k])
    return Model(lexicon, Trees().fit(x, y), *isotonic(margin, y))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of every row of ``docs``, learned from ``labels`` (doc_id, toxic) and the texts."""
    ship(docs.sparkSession)
    labelled = stored(_labelled(labels))
    lexicon = learn_lexicon(docs, labelled)
    table = feature_table(docs, lexicon)
    model = learn(table, labelled, lexicon)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = np.array(batch.column("x").flatten()).reshape(len(batch), len(FEATURES))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.clip(model.scores(x), 0, 1))], names=["doc_id", "score"])

    return table.mapInArrow(releasing(apply), table.select("doc_id").schema.add("score", T.DoubleType()))
