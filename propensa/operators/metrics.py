"""Classification metrics over a table of label, prediction and score.

Labels and predictions are 0 or 1. Counts are one pass with partial sums; the
curves first collapse equal scores and then use running totals, so neither a
common score nor many distinct scores end up in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensa.operators.running import Running, running_totals

LABEL, PREDICTION, SCORE = "label", "prediction", "score"


def predict(df: DataFrame, score: str = SCORE, threshold: float = 0.5) -> DataFrame:
    """Class 1 when the score is above the threshold."""
    return df.withColumn(PREDICTION, (F.col(score) > threshold).cast("int"))


def _ratio(top: str, bottom: str) -> str:
    """0 when there is nothing to divide by."""
    return f"coalesce(try_divide({top}, {bottom}), 0D)"


def _struct(names: Sequence[str], values: Sequence[str]) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in zip(names, values)) + ")"


def _complete(df: DataFrame, *columns: str) -> DataFrame:
    """``df``, where a null in one of the columns is an error when the row is read: no row is left out of a metric."""
    known = F.expr(" and ".join(f"{c} is not null" for c in columns))
    return df.filter(F.assert_true(known, F.lit(f"null among {', '.join(columns)}")).isNull())


def _outcomes(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """True and false positives and negatives: one row, or one per ``by`` group."""
    actual, predicted = f"{LABEL} = 1", f"{PREDICTION} = 1"
    return _complete(df, LABEL, PREDICTION).groupBy(*by).agg(
        F.expr(f"cast(count_if({actual} and {predicted}) as double) as tp"),
        F.expr(f"cast(count_if(not {actual} and {predicted}) as double) as fp"),
        F.expr(f"cast(count_if({actual} and not {predicted}) as double) as fn"),
        F.expr(f"cast(count_if(not {actual} and not {predicted}) as double) as tn"),
    )


def classification_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1: one row, or one per ``by`` group."""
    return _outcomes(df, by).selectExpr(
        *by,
        "try_divide(tp + tn, tp + fp + fn + tn) as accuracy",
        f"{_ratio('tp', 'tp + fp')} as precision",
        f"{_ratio('tp', 'tp + fn')} as recall",
        f"{_ratio('2 * tp', '2 * tp + fp + fn')} as f1_score",
    )


def agreement_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cohen's kappa and Matthews correlation from the four counts: one row, or one per ``by`` group."""
    chances = _outcomes(df, by).selectExpr(
        "*",
        "try_divide(tp + tn, tp + fp + fn + tn) as agreed",
        "try_divide((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp), pow(tp + fp + fn + tn, 2)) as chance",
        "sqrt(tp + fp) * sqrt(tp + fn) * sqrt(tn + fp) * sqrt(tn + fn) as spread",
    )
    return chances.selectExpr(
        *by, f"{_ratio('agreed - chance', '1 - chance')} as kappa", f"{_ratio('tp * tn - fp * fn', 'spread')} as mcc"
    )


def confusion_matrix(df: DataFrame) -> DataFrame:
    """All four cells, empty ones included."""
    cells = {"tn": "0, 0", "fp": "0, 1", "fn": "1, 0", "tp": "1, 1"}
    rows = ", ".join(f"struct({cell}, cast({name} as bigint))" for name, cell in cells.items())
    return _outcomes(df).selectExpr(f"inline(array({rows})) as ({LABEL}, {PREDICTION}, count)")


def classification_report(df: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    The accuracy row holds its value in the F1 column, as in the printed report.
    """
    pairs = _complete(df, LABEL, PREDICTION).groupBy(LABEL, PREDICTION).agg(F.count("*").alias("n"))
    hits = f"if({LABEL} = {PREDICTION}, n, 0L)"
    classes = (
        pairs.selectExpr(
            f"stack(2, {LABEL}, n, 0L, {hits}, {PREDICTION}, 0L, n, 0L) as (class, support, predicted, hits)"
        )
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
        .selectExpr(
            "cast(class as string) as class", "support", "hits",
            f"{_ratio('hits', 'predicted')} as precision",
            f"{_ratio('hits', 'support')} as recall",
            f"{_ratio('2 * hits', 'predicted + support')} as f1_score",
        )
    )
    measures = ("precision", "recall", "f1_score")
    both = classes.rollup("class").agg(
        F.grouping("class").alias("overall"),
        F.sum("support").alias("support"),
        F.sum("hits").alias("hits"),
        *[F.avg(m).alias(m) for m in measures],
        *[F.expr(f"try_divide(sum({m} * support), sum(support))").alias(f"w_{m}") for m in measures],
    )
    columns = ["class", *measures, "support"]
    nothing = "cast(null as double)"
    one_class = _struct(columns, columns)
    averages = [
        _struct(columns, ["'accuracy'", nothing, nothing, "try_divide(hits, support)", "support"]),
        _struct(columns, ["'macro avg'", *measures, "support"]),
        _struct(columns, ["'weighted avg'", *[f"w_{m}" for m in measures], "support"]),
    ]
    return both.selectExpr(f"inline(if(overall = 1, array({', '.join(averages)}), array({one_class})))")


def score_steps(df: DataFrame, by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """One row per distinct score (per ``by`` group), highest first: its positives and negatives,
    both counted down to it (``tp``, ``fp``) and overall, and those of the next lower score."""
    steps = (
        _complete(df, LABEL, SCORE)
        .groupBy(*by, F.col(SCORE).cast("double").alias(SCORE))
        .agg(F.count_if(F.col(LABEL) == 1).alias("pos"), F.count_if(F.col(LABEL) != 1).alias("neg"))
    )
    return running_totals(
        steps,
        order=[SCORE],
        groups=by,
        descending=True,
        what=Running(
            sums={"tp": "pos", "fp": "neg"},
            totals={"all_pos": "pos", "all_neg": "neg"},
            following={"next_pos": "pos", "next_neg": "neg"},
        ),
        ranges=ranges,
    )


def _area() -> Column:
    """Share of (positive, negative) pairs in the right order, equal scores counting half."""
    above = F.col("tp") - F.col("pos")
    right = F.sum(F.col("neg").cast("double") * (above + F.col("pos") / 2))
    return F.try_divide(right, F.max("all_pos").cast("double") * F.max("all_neg"))


def _average_precision() -> Column:
    steps = F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
    return F.try_divide(steps, F.max("all_pos"))


def ranking_metrics(df: DataFrame, by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """ROC AUC (null when only one class is present) and average precision, the sum of recall
    steps weighted by the precision at each: one row, or one per ``by`` group."""
    return score_steps(df, by, ranges).groupBy(*by).agg(
        _area().alias("roc_auc"), _average_precision().alias("average_precision")
    )


def roc_auc(df: DataFrame, by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    return ranking_metrics(df, by, ranges).drop("average_precision")


def average_precision(df: DataFrame, by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    return ranking_metrics(df, by, ranges).drop("roc_auc")


# The step of the highest score has nothing counted before it.
_TOP = "(tp = pos and fp = neg)"


def roc_curve(df: DataFrame, drop_intermediate: bool = True, ranges: int | None = None) -> DataFrame:
    """ROC points from (0, 0) up. Points on the straight line between their neighbours are
    left out by default, as they do not change the curve."""
    steps = score_steps(df, ranges=ranges)
    if drop_intermediate:
        steps = steps.filter(f"{_TOP} or next_pos is null or pos <> next_pos or neg <> next_neg")
    columns = ("fpr", "tpr", "threshold")
    point = _struct(columns, ["try_divide(fp, all_neg)", "try_divide(tp, all_pos)", SCORE])
    origin = _struct(columns, ["0D", "0D", "double('infinity')"])
    return steps.selectExpr(f"inline(if({_TOP}, array({origin}, {point}), array({point})))")


def pr_curve(df: DataFrame, ranges: int | None = None) -> DataFrame:
    """Precision and recall at every threshold, closed by the point (1, 0) without one."""
    steps = score_steps(df, ranges=ranges)
    columns = ("precision", "recall", "threshold")
    point = _struct(columns, ["tp / (tp + fp)", "coalesce(try_divide(tp, all_pos), 1D)", SCORE])
    end = _struct(columns, ["1D", "0D", "cast(null as double)"])
    return steps.selectExpr(f"inline(if({_TOP}, array({point}, {end}), array({point})))")


# Reports by threshold, score band and slice: one grouped pass each.


def threshold_sweep(df: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Outcomes, precision, recall and F1 at each threshold (class 1 above it). A row is counted once,
    by the number of thresholds below its score; the sums over those few counts follow."""
    cuts = sorted(thresholds)
    below = " + ".join(f"if({SCORE} > {cut}D, 1, 0)" for cut in cuts)
    counts = _complete(df, LABEL, SCORE).selectExpr(f"{below} as passed", f"{LABEL} = 1 as actual").groupBy("passed").agg(
        F.count_if("actual").alias("pos"), F.count_if(~F.col("actual")).alias("neg"))
    every = F.array(*[F.struct(F.lit(float(cut)).alias("threshold"), F.lit(i + 1).alias("place")) for i, cut in enumerate(cuts)])
    rows = counts.select("*", F.inline(every))
    outcomes = rows.groupBy("threshold").agg(*[
        F.sum(F.expr(f"if(passed {side} place, {kind}, 0L)")).cast("double").alias(name)
        for name, side, kind in (("tp", ">=", "pos"), ("fp", ">=", "neg"), ("fn", "<", "pos"), ("tn", "<", "neg"))])
    return outcomes.selectExpr(
        "threshold", *[f"cast({c} as bigint) as {c}" for c in ("tp", "fp", "fn", "tn")], f"{_ratio('tp', 'tp + fp')} as precision",
        f"{_ratio('tp', 'tp + fn')} as recall", f"{_ratio('2 * tp', '2 * tp + fp + fn')} as f1_score")


def calibration_bins(df: DataFrame, bins: int = 10) -> DataFrame:
    """Rows, mean score and share of class 1 in score bands of equal width; a score of 1 is in the last band."""
    band = f"least(cast(floor({SCORE} * {bins}) as int), {bins - 1}) as bin"
    return _complete(df, LABEL, SCORE).selectExpr(band, SCORE, LABEL).groupBy("bin").agg(
        F.count("*").alias("n"), F.avg(SCORE).alias("mean_score"), F.avg(LABEL).alias("observed"))


def slice_metrics(df: DataFrame, by: str) -> DataFrame:
    """Rows, share of class 1, accuracy, precision, recall and F1 in each slice."""
    cells = _complete(df, LABEL, PREDICTION).groupBy(by).agg(
        F.count("*").alias("n"), *[F.count_if(F.expr(condition)).cast("double").alias(name) for name, condition in (
            ("tp", f"{LABEL} = 1 and {PREDICTION} = 1"), ("fp", f"{LABEL} = 0 and {PREDICTION} = 1"),
            ("fn", f"{LABEL} = 1 and {PREDICTION} = 0"), ("tn", f"{LABEL} = 0 and {PREDICTION} = 0"))])
    return cells.selectExpr(
        by, "n", "(tp + fn) / n as rate", "(tp + tn) / n as accuracy", f"{_ratio('tp', 'tp + fp')} as precision",
        f"{_ratio('tp', 'tp + fn')} as recall", f"{_ratio('2 * tp', '2 * tp + fp + fn')} as f1_score")


def low_confidence(df: DataFrame, margin: float = 0.1) -> DataFrame:
    """Every row with its distance from the threshold and whether that is under the margin."""
    return _complete(df, SCORE).withColumn("distance", F.abs(F.col(SCORE) - 0.5)).withColumn("uncertain", F.col("distance") < margin)


def _poisson(u: str, most: int = 12) -> str:
    """SQL text: how often a row is drawn when the number of draws is Poisson with mean 1, from a number in [0, 1)."""
    share, total, cuts = math.exp(-1), 0.0, []
    for k in range(most):
        total += share
        cuts.append(total)
        share /= k + 1
    return " + ".join(f"if({u} >= {cut!r}D, 1, 0)" for cut in cuts)


def group_gaps(df: DataFrame, by: str, key: str, replicates: int = 100, level: float = 0.95, seed: int = 7) -> DataFrame:
    """Bias by group: how far a group's share of predicted 1, true positive rate and accuracy lie from all rows', with intervals.

    The intervals are quantiles over bootstrap replicates. A row's draws in a replicate are Poisson numbers from a hash
    of its key, so all replicates are sums of one pass, equal on every run, and no sample is ever drawn.
    Per group: n, and for each measure its value, its gap, and ``_low`` and ``_high`` of the gap. A rate without rows is null.
    """
    columns = _complete(df, LABEL, PREDICTION)
    blocks = -(-replicates // 4)  # a hash has 128 bits, each replicate takes 32
    hashed = columns.select(by, key, LABEL, PREDICTION, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")).withColumn(
        "h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), F.col("block").cast("string"))))
    part = "conv(substring(h, 8 * i + 1, 8), 16, 10) / 4294967296D"
    drawn = hashed.select(by, LABEL, PREDICTION, F.expr(
        f"inline(transform(array(0, 1, 2, 3), i -> named_struct('replicate', 4 * block + i, 'u', {part})))"))
    weighted = drawn.filter(F.col("replicate") < replicates).selectExpr(by, LABEL, PREDICTION, "replicate", f"cast({_poisson('u')} as bigint) as w")
    whole = columns.selectExpr(by, LABEL, PREDICTION, "-1 as replicate", "1L as w")
    sums = whole.unionByName(weighted).groupBy(by, "replicate").agg(
        F.sum("w").alias("n"), F.expr(f"sum(w * {PREDICTION})").alias("chosen"), F.expr(f"sum(w * {LABEL})").alias("positive"),
        F.expr(f"sum(w * {LABEL} * {PREDICTION})").alias("hit"), F.expr(f"sum(if({LABEL} = {PREDICTION}, w, 0))").alias("right"))
    measures = {"selection": ("chosen", "n"), "recall": ("hit", "positive"), "accuracy": ("right", "n")}
    own = [f"{a} / nullif({b}, 0) as {m}" for m, (a, b) in measures.items()]
    # One row per group and replicate from here on.
    total = sums.groupBy(F.col("replicate").alias("of")).agg(*[F.sum(c).alias(c) for c in ("n", "chosen", "positive", "hit", "right")])
    total = total.selectExpr("of", *[f"{a} / nullif({b}, 0) as all_{m}" for m, (a, b) in measures.items()])
    gaps = sums.selectExpr(by, "replicate", "n", *own).join(total, F.col("replicate") == F.col("of")).selectExpr(
        by, "replicate", "n", *measures, *[f"{m} - all_{m} as {m}_gap" for m in measures])
    low, high = (1 - level) / 2, (1 + level) / 2
    point, sampled = "replicate < 0", "replicate >= 0"
    return gaps.groupBy(by).agg(
        F.expr(f"max(n) filter (where {point})").alias("n"),
        *[F.expr(f"max({c}) filter (where {point})").alias(c) for m in measures for c in (m, f"{m}_gap")],
        *[F.expr(f"percentile({m}_gap, {q!r}D) filter (where {sampled})").alias(f"{m}_{side}")
          for m in measures for side, q in (("low", low), ("high", high))])
