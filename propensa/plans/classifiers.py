"""Classifiers of the comparison that Spark ML lacks: discriminant analysis and boosted stumps.

Both learn from a table with ``features`` (vector) and ``label`` (0 or 1) and give models whose ``transform`` adds
``prediction`` and ``probability``, so that they stand beside Spark's own in a comparison.

* Discriminant analysis needs one pass. Count, sums and products of a class are one matrix; each batch of rows
  adds its own, each task hands on one, and a grouped sum merges them. Scores are column expressions.
* Boosting takes one grouped sum of row weights over (feature, cut) a round. A row's weight follows from the stumps so far,
  so the rows are written once; each task adds up its own cells and hands on one row a cell.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensa.session import stored

# Rounds and bounds of the published defaults.
STUMP_ROUNDS = 50
TOLERANCE = 1e-4  # directions of less relative variance are left out of an inverse


# Discriminant analysis


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per class: sums over the rows of every product of two values, a constant 1 being the first value."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        if not len(batch):
            continue
        x = np.stack(batch.column("x").to_numpy(zero_copy_only=False))
        x = np.hstack([np.ones((len(x), 1)), x])
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        for label in np.unique(labels).tolist():
            rows = x[labels == label]
            sums[label] = sums.get(label, 0) + rows.T @ rows
    for label, matrix in sums.items():
        i, j = np.triu_indices(len(matrix))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(i), int(label))), pa.array(i.astype("i4")), pa.array(j.astype("i4")), pa.array(matrix[i, j])],
            names=["label", "i", "j", "total"])


def moments(table: DataFrame) -> DataFrame:
    """(label, i, j, total): for each class the count (0, 0), the sums (0, j) and the products (i, j) of all values.

    ``table`` has ``x`` (array) and ``label``. What a task sends is one matrix a class, whatever the number of its rows.
    """
    rows = table.select("x", F.col("label").cast("int").alias("label"))
    partial = rows.mapInArrow(_products, "label long, i int, j int, total double")
    return partial.groupBy("label", "i", "j").agg(F.sum("total").alias("total"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda total, v: total + v)


def _numbers(values: np.ndarray) -> Column:
    return F.lit(np.asarray(values, dtype=float))


def _inverse(matrix: np.ndarray) -> tuple[np.ndarray, float]:
    """Inverse and log determinant over the directions that vary."""
    size, axes = np.linalg.eigh(matrix)
    kept = size > TOLERANCE**2 * max(size.max(initial=0.0), 1e-300)
    return (axes[:, kept] / size[kept]) @ axes[:, kept].T, float(np.log(size[kept]).sum())


@dataclass(frozen=True)
class DiscriminantModel:
    """Log odds of class 1 as a polynomial of the values: ``square`` (null for the linear form), ``slope``, ``offset``."""

    square: np.ndarray | None
    slope: np.ndarray
    offset: float

    def log_odds(self, x: Column) -> Column:
        linear = _dot(x, _numbers(self.slope)) + F.lit(self.offset)
        if self.square is None:
            return linear
        rows = F.array(*[_numbers(row) for row in self.square])
        return _dot(F.transform(rows, lambda row: _dot(row, x)), x) + linear

    def transform(self, table: DataFrame) -> DataFrame:
        odds = self.log_odds(vector_to_array("features"))
        scored = table.withColumn("__p", 1 / (1 + F.exp(-odds)))
        return scored.select(
            *table.columns, (F.col("__p") > 0.5).cast("double").alias("prediction"),
            array_to_vector(F.array(1 - F.col("__p"), F.col("__p"))).alias("probability"))


def discriminant(sums: DataFrame, quadratic: bool) -> DiscriminantModel:
    """Model from the moments of two classes: normal densities with one covariance or with one each.

    Only the moments, two matrices as wide as a row, come to the driver.
    """
    rows = sums.collect()
    labels = sorted({r["label"] for r in rows})
    if labels != [0, 1]:
        raise ValueError(f"discriminant analysis needs rows of both classes, found {labels}")
    width = 1 + max(r["j"] for r in rows)
    matrix = np.zeros((2, width, width))
    for r in rows:
        matrix[r["label"], r["i"], r["j"]] = matrix[r["label"], r["j"], r["i"]] = r["total"]
    n = matrix[:, 0, 0]
    mean = matrix[:, 0, 1:] / n[:, None]
    scatter = matrix[:, 1:, 1:] - n[:, None, None] * mean[:, :, None] * mean[:, None, :]
    prior = float(np.log(n[1] / n[0]))
    if not quadratic:
        inverse, _ = _inverse(scatter.sum(axis=0) / (n.sum() - 2))
        slope = inverse @ (mean[1] - mean[0])
        return DiscriminantModel(None, slope, prior - float(slope @ (mean[0] + mean[1])) / 2)
    (zero, log_zero), (one, log_one) = (_inverse(scatter[k] / max(1.0, n[k] - 1)) for k in (0, 1))
    offset = prior + (log_zero - log_one + mean[0] @ zero @ mean[0] - mean[1] @ one @ mean[1]) / 2
    return DiscriminantModel((zero - one) / 2, one @ mean[1] - zero @ mean[0], float(offset))


@dataclass(frozen=True)
class Discriminant:
    """Estimator over feature vectors."""

    quadratic: bool = False

    def fit(self, table: DataFrame) -> DiscriminantModel:
        return discriminant(moments(table.select("label", vector_to_array("features").alias("x"))), self.quadratic)


# Boosted stumps


def cut_points(table: DataFrame, most: int = 256) -> list[list[float]]:
    """For each value of ``x``, cuts between its quantiles; all of its values but the largest where they are few and frequent."""
    shares = [(i + 0.5) / (4 * most) for i in range(4 * most)]
    rows = table.select(F.posexplode("x").alias("feature", "value")).groupBy("feature").agg(
        F.percentile_approx("value", shares, 10_000).alias("points"), F.max("value").alias("largest")).collect()
    cuts: list[list[float]] = [[] for _ in rows]
    for r in rows:
        points = [p for p in sorted(set(r["points"])) if p < r["largest"]]
        step = -(-len(points) // most) or 1
        cuts[r["feature"]] = points[::step]
    return cuts


def binned(table: DataFrame, cuts: list[list[float]]) -> DataFrame:
    """``table`` with ``bins`` in place of ``x``: for each value, the number of cuts below it."""
    every = F.array(*[F.lit(np.array(c, dtype=float)) if c else F.array().cast("array<double>") for c in cuts])
    bins = F.transform("x", lambda value, i: F.size(F.filter(F.get(every, i), lambda cut: cut < value)))
    return table.withColumn("bins", bins).drop("x")


def best_stump(rows: DataFrame, digits: int = 9) -> dict[str, Any] | None:
    """The split of one value with the least share of wrongly classified weight, from one grouped sum.

    ``rows`` has ``bins``, ``label`` and ``weight``. ``upper`` is the class above the cut. Equal shares go to the
    first feature, the lowest cut, the upper class 1.
    """
    one = F.sum(F.when(F.col("label") == 1, F.col("weight")).otherwise(0.0))
    cells = rows.select("label", "weight", F.posexplode("bins").alias("feature", "bin")).groupBy("feature", "bin").agg(
        one.alias("one"), (F.sum("weight") - one).alias("zero"))
    return _best(cells, digits)


def _best(cells: DataFrame, digits: int = 9) -> dict[str, Any] | None:
    """The best split of cells (feature, bin, one, zero): the weights of both classes."""
    # As many rows as there are cuts, so one task ranks them whatever the number of rows.
    upto = Window.partitionBy("feature").orderBy("bin")
    whole = Window.partitionBy("feature")
    split = cells.select(
        "feature", "bin", F.sum("one").over(upto).alias("one_low"), F.sum("zero").over(upto).alias("zero_low"),
        F.sum("one").over(whole).alias("ones"), F.sum("zero").over(whole).alias("zeros"),
        F.lead("bin").over(upto).isNotNull().alias("inner")).filter("inner")
    wrong = (F.col("one_low") + F.col("zeros") - F.col("zero_low")) / (F.col("ones") + F.col("zeros"))
    sides = F.explode(F.array(F.struct(F.lit(1).alias("upper"), wrong.alias("error")), F.struct(F.lit(0).alias("upper"), (1 - wrong).alias("error"))))
    rated = split.select("feature", "bin", sides.alias("s")).select("feature", "bin", "s.upper", "s.error")
    best = rated.orderBy(F.round("error", digits), "feature", "bin", F.desc("upper")).first()
    return None if best is None else best.asDict()


def _weighted_cells(stumps: list[dict[str, Any]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task adds up: the weights of its rows after the stumps so far, per (feature, bin) and class."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((0, 0, 3))  # class 1, all, rows
        for batch in batches:
            known = batch.filter(batch.column("bins").is_valid())
            if not len(known):
                continue
            bins = known.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(len(known), -1)
            label = known.column("label").cast(pa.float64()).to_numpy(zero_copy_only=False)
            weight = np.ones(len(known))
            for s in stumps:
                error = max(s["error"], 1e-10)
                vote = np.where(bins[:, s["feature"]] > s["bin"], s["upper"], 1 - s["upper"])
                weight[(vote != label) & ~np.isnan(label)] *= (1 - error) / error
            high = max(int(bins.max(initial=0)) + 1, total.shape[1])
            grown = np.zeros((bins.shape[1], high, 3))
            grown[:total.shape[0], :total.shape[1]] = total
            for feature, column in enumerate(bins.T):
                for i, w in enumerate((np.where(label == 1, weight, 0.0), weight, None)):
                    grown[feature, :, i] += np.bincount(column, w, high)
            total = grown
        feature, place = np.nonzero(total[:, :, 2])
        one, every, _ = total[feature, place].T
        yield pa.RecordBatch.from_arrays(
            [pa.array(feature.astype("i4")), pa.array(place.astype("i4")), pa.array(one), pa.array(every - one)], names=["feature", "bin", "one", "zero"])

    return cells


def boost(rows: DataFrame, rounds: int) -> list[dict[str, Any]]:
    """Stumps with their weights in the vote. Rows carry ``bins`` (equally many) and ``label``.

    Weights start as 1; a wrongly classified row's grows by the odds of the stump being right. Learning ends early
    when a stump is always right, or no better than chance.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package
    kept, stumps = stored(rows.select("bins", "label")), []
    for nth in range(rounds):
        sums = kept.mapInArrow(_weighted_cells(stumps), "feature int, bin int, one double, zero double")
        stump = _best(sums.groupBy("feature", "bin").agg(F.sum("one").alias("one"), F.sum("zero").alias("zero")))
        if stump is None or stump["error"] >= 0.5:
            break
        error = max(stump["error"], 1e-10)
        stumps.append({**stump, "round": nth, "vote": float(np.log((1 - error) / error))})
        if stump["error"] <= 0:
            break
    return stumps


@dataclass(frozen=True)
class StumpModel:
    """Weighted vote of stumps over binned values."""

    cuts: list[list[float]]
    stumps: list[dict[str, Any]]

    def votes(self, x: Column) -> Column:
        """Sum of the votes for class 1 less those for class 0."""
        total = F.lit(0.0)
        for s in self.stumps:
            above = F.get(x, F.lit(s["feature"])) > self.cuts[s["feature"]][s["bin"]]
            total = total + F.when(above == bool(s["upper"]), s["vote"]).otherwise(-s["vote"])
        return total

    def transform(self, table: DataFrame) -> DataFrame:
        scored = table.withColumn("__p", 1 / (1 + F.exp(-self.votes(vector_to_array("features")))))
        return scored.select(
            *table.columns, (F.col("__p") > 0.5).cast("double").alias("prediction"),
            array_to_vector(F.array(1 - F.col("__p"), F.col("__p"))).alias("probability"))


@dataclass(frozen=True)
class BoostedStumps:
    """Estimator over feature vectors."""

    rounds: int = STUMP_ROUNDS

    def fit(self, table: DataFrame) -> StumpModel:
        rows = table.select(F.col("label").cast("int").alias("label"), vector_to_array("features").alias("x"))
        cuts = cut_points(rows)
        return StumpModel(cuts, boost(binned(rows, cuts), self.rounds))
