"""Boosted trees of many trials grown together, one grouped sum per level for all of them.

Values are binned once. A round adds a tree to every trial that still wants one, and a level of all these trees
is one pass: every row sends the first and second derivative of its loss, for each trial, to its cell (trial, node,
feature, bin); the cells are summed before they are shuffled, and each node takes the split of largest gain. Derivatives
are whole numbers of ``UNIT``, so sums do not depend on the order of rows or partitions. The column share is drawn for each tree.
What comes to the driver is one row per node. Margins are written once a round, which cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensa.operators import metrics as mx
from propensa.plans import reasons as rs
from propensa.session import stored

UNIT = 2.0**-24
SHRINK = 1.0  # added to the second derivatives of a node
LEAST_CHILD = 1.0  # sum of second derivatives on both sides of a split
DIGITS = 9  # gains that agree so far are equal; then the first feature and the lowest cut win


@dataclass
class Tree:
    """Nodes of one tree by number: the root is 1, the children of ``k`` are ``2 k`` and ``2 k + 1``."""

    splits: dict[int, tuple[int, int, float]] = field(default_factory=dict)  # feature, bin, gain
    values: dict[int, float] = field(default_factory=dict)


def value_of(g: int, h: int) -> float:
    """Value of a node from the sums of its rows."""
    return -(g * UNIT) / (h * UNIT + SHRINK)


def drawn_columns(n: int, share: float, seed: int, trial: int, tree: int) -> list[int]:
    """The features that one tree may split on."""
    chosen = np.random.default_rng([seed, trial, tree]).permutation(n)[:max(1, int(share * n))]
    return sorted(chosen.tolist())


def _table(values: dict[int, Any], size: int, missing: Any, kind: str) -> Column:
    return F.lit(np.array([values.get(i, missing) for i in range(size)], dtype=kind))


def _node(tree: Tree, levels: int) -> Column:
    """The node that a row is in after some levels; it stays where no split was made."""
    if not levels or not tree.splits:
        return F.lit(1)
    size = 1 << levels
    feature = _table({k: s[0] for k, s in tree.splits.items()}, size, -1, "int32")
    cut = _table({k: s[1] for k, s in tree.splits.items()}, size, 0, "int32")

    def down(node: Column, _: Column) -> Column:
        f = F.get(feature, node)
        right = (F.get(F.col("bins"), f) > F.get(cut, node)).cast("int")
        return F.when((node < size) & (f >= 0), 2 * node + right).otherwise(node)

    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(1), down)


def _sampled(key: str, share: float, seed: int, trial: int, tree: int) -> Column:
    if share >= 1:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed), F.lit(trial), F.lit(tree)), F.lit(1 << 32)) < int(share * (1 << 32))


def _best_splits(cells: DataFrame) -> DataFrame:
    """Per (trial, node): the split of largest gain with the sums of both sides, and the sums of the node."""
    own = Window.partitionBy("trial", "node", "feature")
    upto = own.orderBy("bin")
    split = cells.select("trial", "node", "feature", "bin", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
                         F.sum("g").over(own).alias("g"), F.sum("h").over(own).alias("h"))
    side = lambda g, h: f"({g} * {UNIT!r}D) * ({g} * {UNIT!r}D) / ({h} * {UNIT!r}D + {SHRINK}D)"
    gain = F.expr(f"{side('gl', 'hl')} + {side('(g - gl)', '(h - hl)')} - {side('g', 'h')}")
    least = int(LEAST_CHILD / UNIT)
    allowed = (F.col("hl") >= least) & (F.col("h") - F.col("hl") >= least)
    rated = split.withColumn("gain", F.when(allowed, F.round(gain, DIGITS)))
    best = F.max(F.when(F.col("gain") > 0, F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "gl", "hl")))
    return rated.groupBy("trial", "node").agg(best.alias("best"), F.max("g").alias("g"), F.max("h").alias("h"))


def grow(rows: DataFrame, trials: Sequence[dict[str, Any]], n_features: int, key: str, seed: int = 42) -> tuple[list[list[Tree]], DataFrame]:
    """Trees of every trial, and ``rows`` with ``margins`` (one per trial).

    ``rows`` has the key, ``label`` (0 or 1), ``bins`` and ``learn`` (whether the row is learned from; margins are kept for all).
    A round takes as many passes as the deepest of its trees has levels, and one that writes the margins.
    """
    spark = rows.sparkSession
    grown: list[list[Tree]] = [[] for _ in trials]
    state = stored(rows.select(key, "label", "bins", "learn", F.array_repeat(F.lit(0.0), len(trials)).alias("margins")))
    for r in range(max((t["n_estimators"] for t in trials), default=0)):
        alive = [t for t, p in enumerate(trials) if r < p["n_estimators"]]
        trees = {t: Tree() for t in alive}
        columns = {t: drawn_columns(n_features, trials[t]["colsample_bytree"], seed, t, r) for t in alive}
        for level in range(max(trials[t]["max_depth"] for t in alive)):
            open_ = [t for t in alive if level < trials[t]["max_depth"] and (level == 0 or any(k >= 1 << (level - 1) for k in trees[t].splits))]
            if not open_:
                break
            found = _best_splits(_cells(state, trials, trees, columns, open_, level, key, seed, r)).collect()
            for row in found:
                tree, node, best = trees[row["trial"]], row["node"], row["best"]
                tree.values.setdefault(node, value_of(row["g"], row["h"]))
                if best is not None:
                    tree.splits[node] = (-best["f"], -best["b"], best["gain"])
                    tree.values[2 * node] = value_of(best["gl"], best["hl"])
                    tree.values[2 * node + 1] = value_of(row["g"] - best["gl"], row["h"] - best["hl"])
        for t in alive:
            grown[t].append(trees[t])
        state = stored(state.withColumn("margins", F.array(*[
            F.get("margins", F.lit(t)) + _step(trees[t], trials[t]) if t in trees else F.get("margins", F.lit(t)) for t in range(len(trials))])))
    return grown, state


def _step(tree: Tree, trial: dict[str, Any]) -> Column:
    """What a tree adds to a row's margin."""
    values = _table(tree.values, 2 << trial["max_depth"], 0.0, "float64")
    return trial["learning_rate"] * F.coalesce(F.get(values, _node(tree, trial["max_depth"])), F.lit(0.0))


def _cells(state: DataFrame, trials, trees, columns, open_: list[int], level: int, key: str, seed: int, r: int) -> DataFrame:
    """(trial, node, feature, bin, g, h) of one level, summed over the rows that are learned from."""
    def sent(t: int) -> Column:
        p = 1 / (1 + F.exp(-F.get("margins", F.lit(t))))
        whole = lambda value: F.round(value / UNIT).cast("long")
        node = _node(trees[t], level)
        usable = _sampled(key, trials[t]["subsample"], seed, t, r)
        return F.when(usable, F.struct(
            F.lit(t).alias("trial"), node.alias("node"), whole(p - F.col("label")).alias("g"), whole(p * (1 - p)).alias("h"),
            F.lit(np.array(columns[t], dtype="int32")).alias("columns")))

    spread = state.filter("learn").select("bins", F.explode(F.array(*[sent(t) for t in open_])).alias("s")).filter(
        F.col("s").isNotNull() & (F.col("s.node") >= 1 << level))
    parts = spread.select("s.trial", "s.node", "s.g", "s.h", "bins", F.explode("s.columns").alias("feature"))
    return parts.groupBy("trial", "node", "feature", F.get("bins", F.col("feature")).alias("bin")).agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def as_forest(spark: SparkSession, trees: Sequence[Tree], trial: dict[str, Any], cuts: list[list[float]], names: Sequence[str]) -> rs.Forest:
    """A trial's trees as an ensemble that scores leads and gives reasons: its margin is the log odds of class 1."""
    rows = []
    for number, tree in enumerate(trees):
        place = {node: i for i, node in enumerate(sorted(tree.values))}
        for node, i in place.items():
            feature, cut, _ = tree.splits.get(node, (-1, 0, 0.0))
            left, right = (place[2 * node], place[2 * node + 1]) if feature >= 0 else (-1, -1)
            threshold = cuts[feature][cut] if feature >= 0 else None
            rows.append((number, float(trial["learning_rate"]), i, tree.values[node], left, right, feature, threshold, None))
    return rs.forest(spark.createDataFrame(rows, rs.NODES), max(1, trial["max_depth"]), names)


def trial_metrics(state: DataFrame, n_trials: int) -> DataFrame:
    """Per trial: f1, recall and roc_auc over the rows that were not learned from."""
    margins = state.filter("not learn").select("label", F.posexplode("margins").alias("trial_id", "margin"))
    scores = margins.select("trial_id", "label", (1 / (1 + F.exp(-F.col("margin")))).alias("score")).withColumn(
        "prediction", (F.col("score") > 0.5).cast("int"))
    scores = stored(scores)
    counts = scores.groupBy("trial_id").agg(
        F.count_if((F.col("label") == 1) & (F.col("prediction") == 1)).alias("tp"),
        F.count_if(F.col("label") != F.col("prediction")).alias("wrong"), F.count_if(F.col("label") == 1).alias("positive"))
    rated = counts.selectExpr("trial_id", "coalesce(2 * tp / nullif(2 * tp + wrong, 0), 0D) as f1", "coalesce(tp / nullif(positive, 0), 0D) as recall")
    return rated.join(mx.roc_auc(scores, by=["trial_id"]), "trial_id")
