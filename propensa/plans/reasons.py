"""Why a lead has its score: the margin of a tree ensemble taken apart by feature.

The expected margin of an ensemble (the weighted sum of its roots' values) changes at every split that a
lead passes, and each change belongs to the feature that is split on. So a lead's contributions add up to
its margin less the base value, exactly. The ensemble is read from its own node table and travels to the
tasks as arrays (its size is trees times nodes of a tree, whatever the number of leads). A task walks all leads of
a batch down a tree at once and adds up the changes per feature, so that a lead leaves it as one row.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensa.session import scratch_path

NODE_COLUMNS = ["node", "value", "left", "right", "feature", "threshold", "categories"]
NODES = ("tree int, weight double, node int, value double, left int, right int, feature int, "
         "threshold double, categories array<double>")


@dataclass(frozen=True)
class Forest:
    """One row with the trees of an ensemble, the depth of its deepest tree and the names of its inputs.

    Nodes are numbered from 0 in each tree, the root first; a leaf has -1 for its children. A value at
    most the threshold, or one of the categories, goes left.
    """

    trees: DataFrame
    depth: int
    names: list[str]


def forest(nodes: DataFrame, depth: int, names: Sequence[str]) -> Forest:
    """An ensemble from its node table (``NODES``)."""
    by_tree = nodes.groupBy("tree").agg(
        F.max("weight").alias("weight"), F.array_sort(F.collect_list(F.struct(*NODE_COLUMNS))).alias("nodes"))
    trees = by_tree.agg(F.array_sort(F.collect_list(F.struct("tree", "weight", "nodes"))).alias("trees"))
    return Forest(trees, depth, list(names))


def fitted_forest(model: GBTClassificationModel, names: Sequence[str], spark) -> Forest:
    """The trees of a fitted model, read from the tables that it is saved as."""
    path = scratch_path(spark, "ensemble")
    model.write().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weight")
    split = "nodeData.split.leftCategoriesOrThreshold"
    nodes = spark.read.parquet(f"{path}/data").join(weights, F.col("treeID") == F.col("tree")).selectExpr(
        "tree", "weight", "nodeData.id as node", "nodeData.prediction as value", "nodeData.leftChild as left",
        "nodeData.rightChild as right", "nodeData.split.featureIndex as feature",
        f"if(nodeData.split.numCategories < 0, get({split}, 0), null) as threshold",
        f"if(nodeData.split.numCategories < 0, null, {split}) as categories")
    return forest(nodes, max(1, model.getMaxDepth()), names)


def _bound(value: Column, body) -> Column:
    """``body`` of ``value``, computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _path(nodes: Column, x: Column, depth: int) -> Column:
    """The nodes that a lead passes in one tree, from the root to its leaf."""
    def onward(path: Column, _: Column) -> Column:
        def child(last: Column) -> Column:
            value = F.get(x, last["feature"])
            left = F.when(last["categories"].isNotNull(), F.array_contains(last["categories"], value)).otherwise(value <= last["threshold"])
            return F.when(last["left"] < 0, path).otherwise(
                F.concat(path, F.array(F.get(nodes, F.when(left, last["left"]).otherwise(last["right"])))))

        return _bound(F.element_at(path, -1), child)

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.array(F.get(nodes, F.lit(0))), onward)


def margin(trees: Column, x: Column, depth: int) -> Column:
    """The weighted sum of the leaves that a lead falls in, as an expression."""
    return F.aggregate(trees, F.lit(0.0), lambda total, t: total + t["weight"] * F.element_at(_path(t["nodes"], x, depth), -1)["value"])


@dataclass(frozen=True)
class Tree:
    """Nodes of one tree as arrays. A leaf is its own child."""

    weight: float
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    categories: dict[int, np.ndarray]

    def step(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The next nodes of leads that are in the nodes ``at``; a value that is missing goes right."""
        value = x[self.feature[at], np.arange(len(at))]
        left = value <= self.threshold[at]
        for node, chosen in self.categories.items():
            here = at == node
            left[here] = np.isin(value[here], chosen)
        return np.where(left, self.left[at], self.right[at])

    def goes_left(self, node: int, value: np.ndarray) -> np.ndarray:
        """Which values go left in one node; one that is missing goes right."""
        return np.isin(value, self.categories[node]) if node in self.categories else value <= self.threshold[node]


def _trees(explained: Forest) -> list[Tree]:
    """The ensemble on the driver: as many rows as it has nodes."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package
    found = []
    for tree in explained.trees.first()["trees"] or []:
        nodes = tree["nodes"]
        own = np.arange(len(nodes))
        left, right, feature = (np.array([n[c] for n in nodes]) for c in ("left", "right", "feature"))
        leaf = left < 0
        found.append(Tree(
            tree["weight"], np.array([n["value"] for n in nodes]), np.where(leaf, own, left), np.where(leaf, own, right),
            np.where(leaf, 0, feature), np.array([np.nan if n["threshold"] is None else n["threshold"] for n in nodes]), leaf,
            {i: np.array(n["categories"]) for i, n in enumerate(nodes) if not leaf[i] and n["categories"] is not None}))
    return found


def _base(trees: Sequence[Tree]) -> float:
    return sum((t.weight * float(t.value[0]) for t in trees), 0.0)


def _held(tree: Tree, x: np.ndarray, leads: np.ndarray, place: int, values: np.ndarray) -> np.ndarray:
    """The sum of the leaves that ``leads`` fall in, for each of the values that the feature ``place`` is set to (-1: none is set).

    Leads part at the splits of the other features and values at the splits of this one, so one walk serves all values.
    """
    sums = np.zeros(len(values))

    def down(node: int, here: np.ndarray, chosen: np.ndarray) -> None:
        if tree.leaf[node]:
            sums[chosen] += len(here) * tree.value[node]
            return
        feature = tree.feature[node]
        if feature == place:
            left = tree.goes_left(node, values)
            parts = [(here, chosen & left), (here, chosen & ~left)]
        else:
            left = tree.goes_left(node, x[feature, here])
            parts = [(here[left], chosen), (here[~left], chosen)]
        for child, (some, kept) in zip((tree.left[node], tree.right[node]), parts):
            if len(some) and kept.any():
                down(child, some, kept)

    down(0, leads, np.ones(len(values), dtype=bool))
    return sums


def _changes(trees: Sequence[Tree], x: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Per feature and lead: the sum of the margin's changes at the splits of that feature, and whether there were any."""
    sums, split = np.zeros(x.shape), np.zeros(x.shape, dtype=bool)
    leads = np.arange(x.shape[1])
    for tree in trees:
        at = np.zeros(len(leads), dtype=int)
        for _ in range(depth):
            below = tree.step(at, x)
            feature = tree.feature[at]
            sums[feature, leads] += tree.weight * (tree.value[below] - tree.value[at])
            split[feature, leads] |= ~tree.leaf[at]
            at = below
    return sums, split


def _values(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of a batch of leads by feature, NaN where one is null or missing, and how many each lead has."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=float)
    lead = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    x = np.full((width, len(sizes)), np.nan)
    known = place < width
    x[place[known], lead[known]] = flat[known]
    return x, sizes


def _width(trees: Sequence[Tree], names: Sequence[str]) -> int:
    return max([len(names), 1, *[1 + int(t.feature.max()) for t in trees]])


def with_values(table: DataFrame, key: str) -> DataFrame:
    """Key and feature values as an array, from a table with a feature vector."""
    return table.select(key, vector_to_array("features").alias("x"))


def reasons(table: DataFrame, explained: Forest, key: str = "mailchimp_id", top: int | None = None) -> DataFrame:
    """Per lead and feature that it was split on: value, contribution, rank by size, and the lead's base value and margin.

    ``table`` holds a unique key and the feature values ``x``. ``top`` keeps the largest contributions of each lead.
    A lead that no tree splits has no rows.
    """
    trees, depth = _trees(explained), explained.depth
    width, base = _width(trees, explained.names), _base(trees)

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, _ = _values(batch.column("x"), width)
            sums, split = _changes(trees, x, depth)
            ends = np.concatenate([[0], np.cumsum(split.sum(axis=0))]).astype("i4")
            lead, place = np.nonzero(split.T)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v)) for v in (place.astype("i4"), sums[place, lead])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column("x"), *lists], names=["lead", "x", "places", "changes"])

    rows = table.select(F.col(key).alias("lead"), F.col("x").cast("array<double>").alias("x"))
    changes = rows.mapInArrow(explain, T.StructType([
        *rows.schema.fields, T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("changes", T.ArrayType(T.DoubleType()))]))
    valued = F.transform("places", lambda p: F.get("x", p))
    # Dealt by lead once, for the sums and the ranks.
    dealt = changes.select(F.col("lead").alias(key), F.arrays_zip("places", valued.alias("values"), "changes").alias("c")).repartition(key)
    sums = dealt.select(key, F.lit(base).alias("base"), F.explode("c").alias("c")).groupBy(
        key, "base", F.col("c.places").alias("place"), F.col("c.values").alias("value")).agg(F.sum("c.changes").alias("contribution"))
    own = Window.partitionBy(key)
    largest = own.orderBy(F.abs("contribution").desc(), "place")
    names = F.array(*[F.lit(n) for n in explained.names])
    ranked = sums.select(
        key, F.get(names, F.col("place")).alias("feature"), "value", "contribution", "base",
        (F.col("base") + F.sum("contribution").over(own)).alias("margin"), F.row_number().over(largest).alias("rank"))
    return ranked if top is None else ranked.filter(F.col("rank") <= top)


def partial_dependence(table: DataFrame, explained: Forest, grid: dict[str, Sequence[float]]) -> DataFrame:
    """Mean margin of all leads with one feature set to each of its grid values: feature, value, mean_margin."""
    trees = _trees(explained)
    width = _width(trees, explained.names)
    split = [set(t.feature[~t.leaf].tolist()) for t in trees]
    held = [(explained.names.index(name), np.array(values, dtype=float)) for name, values in grid.items()]
    variants = [(name, float(v)) for name, values in grid.items() for v in values]

    def vary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = [np.zeros(len(values)) for _, values in held], 0
        for batch in batches:
            x, sizes = _values(batch.column("x"), width)
            n += len(sizes)
            leads = np.arange(len(sizes))
            for tree, features in zip(trees, split):
                as_is = tree.weight * _held(tree, x, leads, -1, np.zeros(1))[0]
                for total, (place, values) in zip(sums, held):
                    if place not in features:  # setting it moves no lead in this tree
                        total += as_is
                        continue
                    known = sizes > place
                    moved, left_alone = _held(tree, x, leads[known], place, values), _held(tree, x, leads[~known], -1, values)
                    total += tree.weight * (moved + left_alone)
        if n:
            names, values = zip(*variants) if variants else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(values, pa.float64()), pa.array(np.concatenate([np.zeros(0), *sums])),
                 pa.array([n] * len(variants), pa.int64())],
                names=["feature", "value", "total", "n"])

    totals = table.select(F.col("x").cast("array<double>").alias("x")).mapInArrow(vary, "feature string, value double, total double, n long")
    return totals.groupBy("feature", "value").agg((F.sum("total") / F.sum("n")).alias("mean_margin"))


def quantile_grid(table: DataFrame, explained: Forest, features: Sequence[str], points: int = 10) -> dict[str, list[float]]:
    """Grid values of some features: their distinct quantiles, in one pass."""
    shares = [i / (points - 1) for i in range(points)]
    found = table.agg(*[
        F.percentile_approx(F.get("x", F.lit(explained.names.index(f))), shares, 1000).alias(f) for f in features]).first()
    return {f: sorted(set(found[f] or [])) for f in features}
