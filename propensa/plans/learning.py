"""Fitting: feature stages, boosted trees, random search and model comparison."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from multiprocessing.pool import ThreadPool
from typing import Any

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.functions import features as fx
from propensa.functions.hashing import hash_text, hash_unit
from propensa.operators import metrics as mx
from propensa.operators.columns import MISSING
from propensa.operators.encode import ordinal
from propensa.operators.running import Running, running_totals
from propensa.operators.split import TRAIN, VALIDATION, fold_rows
from propensa.plans.boosting import as_forest, grow, trial_metrics
from propensa.plans.classifiers import BoostedStumps, Discriminant, binned, cut_points
from propensa.plans.reasons import Forest
from propensa.session import ensure_checkpoint_dir, scratch_path, stored

TARGET = "made_purchase"
PREFIX = "f_"
FOLD, PART = "fold", "part"
POOL = "spark.scheduler.pool"

# Seeds and sizes of the search and of the comparison.
MODEL_SEED = 42
SEARCH_SEED = 42
TRIALS = 12
WORKERS = 3
COMPARE_SEED = 123
COMPARE_FOLDS = 10
COMPARE_TRAIN_SIZE = 0.7
RATINGS = ["1", "2", "3", "4", "5"]

# Boosting passes over its rows some hundred times: up to so many rows stay in the tasks they lie in; above, a task has at least and at most so many.
SPREAD_ROWS = 100_000
LEAST_TASK_ROWS = 20_000
MOST_TASK_ROWS = 1_000_000

# Search space in drawing order. Integer ranges exclude their upper bound.
SEARCH_SPACE = {
    "max_depth": ("integer", 3, 8),
    "learning_rate": ("uniform", 0.01, 0.3),
    "n_estimators": ("integer", 50, 200),
    "subsample": ("uniform", 0.7, 1.0),
    "colsample_bytree": ("uniform", 0.7, 1.0),
}

DATE_FEATURES = list(fx.date_features())
CONTACT_FEATURES = ["member_rating", "country_code", "tag_count"]
DERIVED_FEATURES = [*DATE_FEATURES, "is_free_email", "tag_count_by_optin_day"]
LEAD_FIELDS = ["user_email", "optin_time", "country_code", "member_rating", "tag_count"]


def lead_features(tag_columns: Sequence[str]) -> list[str]:
    """Feature order of a model: contact fields, tags, then derived columns."""
    return [*CONTACT_FEATURES, *tag_columns, *DERIVED_FEATURES]


def feature_stages(
    tag_columns: Sequence[str], reference_date: datetime, one_hot: bool = False, unseen: str = "error"
) -> list[Any]:
    """Stages from raw lead fields to the feature vector. Every step is JVM-side and saved with the model."""
    when = "cast(optin_time as timestamp)"
    reference = fx.timestamp_sql(reference_date)
    number = {
        "member_rating": f"coalesce(member_rating, {MISSING})",
        "tag_count": "coalesce(tag_count, 0)",
        **{name: f"coalesce(`{name}`, 0)" for name in tag_columns},
    }
    derived = {
        **fx.date_features(when, reference),
        "is_free_email": fx.email_features()["is_free_email"],
    }
    selected = [f"{fx.standard_country()} as {PREFIX}country_code"]
    selected += [f"cast({sql} as double) as `{PREFIX}{name}`" for name, sql in number.items()]
    selected += [
        f"cast(coalesce({sql}, {MISSING}) as double) as {PREFIX}{name}" for name, sql in derived.items()
    ]
    rate = fx.tag_rate(f"{PREFIX}tag_count", f"{PREFIX}optin_days")
    selected.append(f"coalesce({rate}, {MISSING}) as {PREFIX}tag_count_by_optin_day")
    row_features = SQLTransformer(statement=f"SELECT *, {', '.join(selected)} FROM __THIS__")

    codes = StringIndexer(
        inputCol=f"{PREFIX}country_code", outputCol=f"{PREFIX}country_index",
        stringOrderType="alphabetAsc", handleInvalid=unseen,
    )
    country = f"{PREFIX}country_index"
    stages: list[Any] = [row_features, codes]
    if one_hot:
        stages.append(OneHotEncoder(inputCols=[country], outputCols=[f"{PREFIX}country_hot"]))
        country = f"{PREFIX}country_hot"
    inputs = [country if n == "country_code" else f"{PREFIX}{n}" for n in lead_features(tag_columns)]
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


@dataclass(frozen=True)
class Featurizer:
    """Fitted feature stages with the names of their inputs and outputs."""

    pipeline: PipelineModel
    tag_columns: list[str]
    reference_date: datetime

    @property
    def features(self) -> list[str]:
        return lead_features(self.tag_columns)

    @property
    def fields(self) -> list[str]:
        return [*LEAD_FIELDS, *self.tag_columns]


def fit_featurizer(leads: DataFrame, one_hot: bool = False, unseen: str = "error") -> Featurizer:
    """Fix the reference date, the tag columns and the country codes on ``leads``."""
    # Read as text: a collected time would be shifted to the time zone of the Python process.
    latest = leads.selectExpr("cast(max(cast(optin_time as timestamp)) as string) as latest").first()["latest"]
    reference_date = datetime.fromisoformat(latest)
    tag_columns = [
        c for c in leads.columns if c.startswith("tag_") and c not in ("tag_count", "tag_count_by_optin_day")
    ]
    stages = feature_stages(tag_columns, reference_date, one_hot, unseen)
    return Featurizer(Pipeline(stages=stages).fit(leads), tag_columns, reference_date)


def training_table(
    leads: DataFrame, featurizer: Featurizer, keep: Sequence[str] = ("mailchimp_id", FOLD), target: str = TARGET
) -> DataFrame:
    """Label and feature vector, written once: every trial and fold reads this table.

    It is partitioned by fold (the last of ``keep`` that is present), so that a fit reads its own rows only.
    """
    kept = [c for c in keep if c in leads.columns]
    vectors = featurizer.pipeline.transform(leads).select(
        *kept, F.col(target).cast("double").alias("label"), "features"
    )
    folds = [c for c in kept if c in (FOLD, PART)]
    return stored(vectors, partition_by=folds[-1] if folds else None)


def boosted_trees(params: dict[str, Any], seed: int = MODEL_SEED) -> GBTClassifier:
    """Boosted trees with the searched parameters; the column share is drawn per tree node."""
    return GBTClassifier(
        featuresCol="features",
        labelCol="label",
        maxDepth=int(params["max_depth"]),
        stepSize=float(params["learning_rate"]),
        maxIter=int(params["n_estimators"]),
        subsamplingRate=float(params["subsample"]),
        featureSubsetStrategy=str(float(params["colsample_bytree"])),
        seed=seed,
    )


def spread(rows: DataFrame) -> DataFrame:
    """Training rows dealt out evenly, one task a core, in a fixed order: a level of a tree is a pass over all of them, as long as its largest task.

    The files of a written table are as uneven as the tasks that wrote them. Rows that fit into few tasks stay as they lie.
    """
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    if n <= SPREAD_ROWS:
        return rows
    waves = -(-n // (cores * MOST_TASK_ROWS))
    tasks = min(cores * waves, n // LEAST_TASK_ROWS)
    columns = [vector_to_array(F.col(c)) if c == "features" else F.col(c) for c in rows.columns]
    # By a hash of the whole row: equal or missing keys do not meet in one task. Equal rows are interchangeable.
    mark = F.xxhash64(*columns)
    marked = rows.withColumn("__mark", mark).repartition(tasks, "__mark")
    return marked.sortWithinPartitions("__mark").drop("__mark")


def scored(model: Model, table: DataFrame) -> DataFrame:
    """Label, predicted class and score of class 1; the margin stands in where a model has no probability."""
    out = model.transform(table)
    score = "probability" if "probability" in out.columns else "rawPrediction"
    return out.select(
        *[c for c in table.columns if c not in ("features", "label")],
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array(score)[1].alias("score"),
    )


def class_scores(model: Model, table: DataFrame) -> DataFrame:
    """Predicted class with the score of each class; the margin stands in where a model has no probability."""
    out = model.transform(table)
    score = "probability" if "probability" in out.columns else "rawPrediction"
    return out.select(
        *[c for c in table.columns if c not in ("features", "label")],
        F.col("prediction").cast("int").alias("prediction_label"),
        vector_to_array(score)[0].alias("prediction_score_0"),
        vector_to_array(score)[1].alias("prediction_score_1"),
    )


def evaluate_scores(table: DataFrame) -> dict[str, float]:
    """All single-number metrics of a scored table, read from one written copy."""
    kept = stored(table.select("label", "prediction", "score"))
    classes = mx.classification_metrics(kept).first().asDict()
    agreement = mx.agreement_metrics(kept).first().asDict()
    ranks = mx.ranking_metrics(kept).first().asDict()
    return {**classes, **agreement, **ranks}


def evaluate_groups(table: DataFrame, by: Sequence[str]) -> dict[tuple, dict[str, float]]:
    """The same metrics for each group of a written scored table: a few passes for all groups."""
    found: dict[tuple, dict[str, float]] = {}
    for measured in (mx.classification_metrics, mx.agreement_metrics, mx.ranking_metrics):
        for row in measured(table, by=by).collect():
            found.setdefault(tuple(row[c] for c in by), {}).update(row.asDict())
    return found


# Random search


def sample_trials(n: int = TRIALS, seed: int = SEARCH_SEED, space: dict | None = None) -> list[dict[str, Any]]:
    """Parameter sets drawn one after the other from the search space."""
    random = np.random.default_rng(seed)
    draw: dict[str, Callable[[float, float], Any]] = {
        "integer": lambda low, high: int(random.integers(low, high)),
        "uniform": lambda low, high: float(random.uniform(low, high)),
    }
    space = space or SEARCH_SPACE
    return [{name: draw[kind](low, high) for name, (kind, low, high) in space.items()} for _ in range(n)]


TRIAL_SCHEMA = (
    "trial_id int, max_depth int, learning_rate double, n_estimators int, subsample double, "
    "colsample_bytree double, f1 double, recall double, roc_auc double, seconds double"
)


def table_mark(table: DataFrame) -> str:
    """Text that changes when the rows of a training table do: their number and a sum of their hashes."""
    columns = [vector_to_array(F.col(c)) if c == "features" else F.col(c) for c in sorted(table.columns)]
    row = table.select(F.xxhash64(*columns).alias("h")).agg(F.count("*").alias("n"), F.expr("bit_xor(h)").alias("x")).first()
    return f"{row['n']}:{row['x']}"


def trial_key(number: int, chosen: dict[str, Any], seed: int, mark: str) -> str:
    """Name of a trial in the log: equal for the same parameters, place, seed and rows, and for nothing else."""
    return hashlib.sha256(json.dumps([number, sorted(chosen.items()), seed, mark]).encode()).hexdigest()[:32]


def logged_trials(spark: SparkSession, log: str) -> DataFrame:
    """The trials of a log (with their ``key``) that were committed; none if there is no log yet."""
    schema = f"{TRIAL_SCHEMA}, key string"
    try:
        return spark.read.schema(schema).parquet(log)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run_trials(
    table: DataFrame, params: Sequence[dict[str, Any]], workers: int = WORKERS, seed: int = MODEL_SEED, log: str | None = None
) -> DataFrame:
    """Fit every parameter set on the train fold and measure it on the validation fold.

    Trials run side by side from driver threads, each in its own scheduler pool, so that
    they share the executors evenly; the rows stay on the executors. With ``log``, a trial is written
    there as it ends, under its key: a search that is started again on the same rows fits only what is missing,
    and a trial that is written twice is the same row.
    """
    spark = table.sparkSession
    ensure_checkpoint_dir(spark)
    train, val = fold_rows(table, TRAIN), fold_rows(table, VALIDATION)
    keys, known = {}, {}
    if log is not None:
        mark = table_mark(table)
        keys = {n: trial_key(n, chosen, seed, mark) for n, chosen in enumerate(params)}
        wanted = logged_trials(spark, log).filter(F.col("key").isin(list(keys.values())))
        known = {r["trial_id"]: tuple(r)[:-1] for r in wanted.collect()}

    @inheritable_thread_target(spark)
    def trial(job: tuple[int, dict[str, Any]]) -> tuple:
        number, chosen = job
        spark.sparkContext.setLocalProperty(POOL, f"trial-{number}")
        started = time.monotonic()
        model = boosted_trees(chosen, seed).fit(train)
        found = evaluate_scores(scored(model, val))
        auc = None if found["roc_auc"] is None else float(found["roc_auc"])
        row = (
            number, chosen["max_depth"], chosen["learning_rate"], chosen["n_estimators"], chosen["subsample"],
            chosen["colsample_bytree"], float(found["f1_score"]), float(found["recall"]), auc,
            time.monotonic() - started,
        )
        if log is not None:
            one = spark.createDataFrame([row], TRIAL_SCHEMA).coalesce(1)
            one.write.mode("overwrite").parquet(f"{log}/key={keys[number]}")
        return row

    missing = [job for job in enumerate(params) if job[0] not in known]
    with ThreadPool(workers) as pool:
        rows = pool.map(trial, missing, chunksize=1)
    return spark.createDataFrame(sorted([*known.values(), *rows]), TRIAL_SCHEMA)


def trial_summary(trials: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """Number of trials, best and mean metric, and the parameters of the best (the earliest of equals)."""
    best = F.max_by(F.struct("trial_id", *SEARCH_SPACE), F.struct(metric, -F.col("trial_id")))
    return trials.agg(
        F.count("*").alias("n_trials"),
        F.max(metric).alias(f"best_{metric}"),
        F.avg(metric).alias(f"mean_{metric}"),
        best.alias("best"),
    ).select("n_trials", f"best_{metric}", f"mean_{metric}", "best.*")


def best_params(trials: DataFrame, metric: str = "roc_auc") -> dict[str, Any]:
    row = trial_summary(trials, metric).first()
    return {name: row[name] for name in SEARCH_SPACE}


def refit(table: DataFrame, params: dict[str, Any], seed: int = MODEL_SEED) -> Model:
    """Fit on the train and validation folds together."""
    ensure_checkpoint_dir(table.sparkSession)
    return boosted_trees(params, seed).fit(spread(fold_rows(table, TRAIN, VALIDATION)))


# Importance


def feature_importance(model: Model, names: Sequence[str], spark: Any) -> DataFrame:
    """Split gain share per feature, largest first."""
    gains = model.featureImportances.toArray()
    rows = [(name, float(gain)) for name, gain in zip(names, gains)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def permutation_importance(
    model: Model, table: DataFrame, names: Sequence[str], key: str = "mailchimp_id", seed: int = MODEL_SEED
) -> DataFrame:
    """Loss of ROC AUC when one feature takes its value from another row.

    Each row borrows from the next row in a seeded hash order (rows with an equal
    key follow one another, in any order). That pairing is made once for all
    features; the variants of a row are then scored where the row is, and only
    counts per (feature, score) are shuffled.
    """
    rows = table.select(
        "label", vector_to_array("features").alias("x"), hash_text(key, seed).alias("__hash"),
        F.monotonically_increasing_id().alias("__row"),
    )
    paired = running_totals(rows, ["__hash", "__row"], Running(sums={}, following={"donor": "x"}))
    donor = F.coalesce("donor", "x")
    column = F.col("i")
    swapped = F.concat(
        F.slice("x", 1, column), F.slice(donor, column + 1, 1),
        F.slice("x", column + 2, F.size("x") - column - 1),
    )
    variants = F.explode(F.sequence(F.lit(-1), F.size("x") - 1))
    scores = scored(model, paired.select("label", "x", "donor", variants.alias("i")).select(
        "label", "i", array_to_vector(F.when(column < 0, F.col("x")).otherwise(swapped)).alias("features")
    ))
    per_feature = stored(mx.roc_auc(scores, by=["i"]))
    base = per_feature.filter(column < 0).select("roc_auc").scalar()
    labels = F.array(*[F.lit(n) for n in names])
    return per_feature.filter(column >= 0).select(
        F.get(labels, column).alias("feature"),
        F.col("roc_auc").alias("shuffled_auc"),
        (base - F.col("roc_auc")).alias("importance"),
    )


# Comparison of classifiers


def _classifiers(seed: int, iterations: int) -> dict[str, Estimator | BoostedStumps | Discriminant]:
    common = {"featuresCol": "features", "labelCol": "label"}
    return {
        "lr": LogisticRegression(**common, maxIter=iterations * 5),
        "nb": NaiveBayes(**common, modelType="gaussian"),
        "svm": LinearSVC(**common, maxIter=iterations * 5),
        "dt": DecisionTreeClassifier(**common, seed=seed),
        "rf": RandomForestClassifier(**common, seed=seed, numTrees=iterations),
        "gbc": GBTClassifier(**common, seed=seed, maxIter=iterations),
        "lda": Discriminant(),
        "qda": Discriminant(quadratic=True),
        "ada": BoostedStumps(iterations),
    }


# A step of these sums over all rows, some hundred times a fit. With fewer rows a task than this, starting tasks takes the time.
STEPWISE = ["lr", "svm"]
STEP_ROWS = 100_000

HOLDOUT = -1
FAMILIES = {
    "tree": ["dt", "rf", "gbc"], "linear": ["lr", "svm", "lda"], "discriminant": ["lda", "qda"],
    "all": ["lr", "nb", "svm", "dt", "rf", "gbc", "lda", "qda", "ada"],
}


@dataclass(frozen=True)
class CompareSetup:
    """Settings of a model comparison."""

    target: str = TARGET
    seed: int = COMPARE_SEED
    folds: int = COMPARE_FOLDS
    train_size: float = COMPARE_TRAIN_SIZE
    iterations: int = 20
    ratings: list[str] = field(default_factory=lambda: list(RATINGS))


def compare_table(leads: DataFrame, setup: CompareSetup, key: str = "mailchimp_id") -> DataFrame:
    """Comparison matrix: rating by rank, country one-hot, and the part each key belongs to.

    Parts 0 and up are the cross-validation folds; part ``HOLDOUT`` is kept out of them.
    """
    unit = hash_unit(key, setup.seed)
    part = F.when(unit < setup.train_size, F.floor(unit / setup.train_size * setup.folds)).otherwise(HOLDOUT)
    ranked = leads.withColumn("member_rating", ordinal("member_rating", setup.ratings))
    parted = ranked.withColumn(PART, part.cast("int"))
    featurizer = fit_featurizer(parted, one_hot=True)
    return training_table(parted, featurizer, keep=(key, PART), target=setup.target)


def leaderboard(
    table: DataFrame,
    setup: CompareSetup,
    include: Sequence[str] | None = None,
    sort: str = "f1",
    n_select: int | None = None,
    workers: int | None = None,
) -> DataFrame:
    """Cross-validated means per classifier, best first; ``include`` limits the classifiers.

    So many fits run side by side as keep the cores busy (``WORKERS`` at least). Each writes its scores; all are measured together.
    """
    spark = table.sparkSession
    ensure_checkpoint_dir(spark)
    available = _classifiers(setup.seed, setup.iterations)
    chosen = list(available) if include is None else [m for m in include if m in available]

    @inheritable_thread_target(spark)
    def fit_part(job: tuple[str, int]) -> tuple:
        name, part = job
        spark.sparkContext.setLocalProperty(POOL, f"{name}-{part}")
        started = time.monotonic()
        train = table.filter((F.col(PART) != part) & (F.col(PART) != HOLDOUT))
        held_out = table.filter(F.col(PART) == part)
        if name in STEPWISE:
            train = train.coalesce(tasks)
        scores = scored(available[name].fit(train), held_out).select("label", "prediction", "score")
        scores.write.parquet(f"{path}/model={name}/{PART}={part}")
        return name, part, time.monotonic() - started

    path, tasks = scratch_path(spark, "scores"), max(1, table.count() // STEP_ROWS)
    jobs = [(name, part) for name in chosen for part in range(setup.folds)]
    workers = workers or max(WORKERS, spark.sparkContext.defaultParallelism // max(1, table.rdd.getNumPartitions()))
    with ThreadPool(workers) as pool:
        fitted = pool.map(fit_part, jobs, chunksize=1)
    schema = f"label int, prediction int, score double, model string, {PART} int"
    scores = spark.read.schema(schema).parquet(path) if jobs else spark.createDataFrame([], schema)
    groups = evaluate_groups(scores, ["model", PART])
    rows = []
    for name, part, seconds in fitted:
        found = groups.get((name, part)) or evaluate_scores(scores.limit(0))  # a part without rows
        numbers = [found[m] for m in ("accuracy", "roc_auc", "recall", "precision", "f1_score", "kappa", "mcc")]
        rows.append((name, part, *[None if v is None else float(v) for v in numbers], seconds))
    measures = ["accuracy", "auc", "recall", "precision", "f1", "kappa", "mcc", "seconds"]
    results = spark.createDataFrame(
        rows, "model string, part int, " + ", ".join(f"{m} double" for m in measures)
    )
    return ranked_board(results, measures, sort, n_select)


def ranked_board(results: DataFrame, measures: Sequence[str], sort: str = "f1", n_select: int | None = None) -> DataFrame:
    """Means per model over its parts, best first, and how many parts have the measure sorted by; the first ``n_select``."""
    board = results.groupBy("model").agg(*[F.avg(m).alias(m) for m in measures], F.count(sort).cast("int").alias("parts"))
    board = board.orderBy(F.desc(sort), "model")
    return board if n_select is None else board.limit(n_select)


def fit_best(
    table: DataFrame, setup: CompareSetup, board: DataFrame, sort: str = "f1"
) -> tuple[str, Model, DataFrame]:
    """Refit the leading classifier on all folds; returns its name, model and held-out scores."""
    ensure_checkpoint_dir(table.sparkSession)
    name = board.orderBy(F.desc(sort), "model").first()["model"]
    model = _classifiers(setup.seed, setup.iterations)[name].fit(table.filter(F.col(PART) != HOLDOUT))
    return name, model, scored(model, table.filter(F.col(PART) == HOLDOUT))


# Search with all trials grown together


def run_trials_together(
    table: DataFrame, params: Sequence[dict[str, Any]], names: Sequence[str], seed: int = MODEL_SEED, key: str = "mailchimp_id"
) -> tuple[DataFrame, list[Forest]]:
    """The trials of a search with histogram trees that share every pass, and their ensembles.

    Values are cut between quantiles of the train fold. A level of all trials' trees is one grouped sum, so a search takes about
    as many jobs as its longest trial has levels. The metrics are those of the validation fold.
    """
    spark = table.sparkSession
    started = time.monotonic()
    rows = fold_rows(table, TRAIN, VALIDATION).select(
        key, F.col("label").cast("int").alias("label"), vector_to_array("features").alias("x"), (F.col(FOLD) == TRAIN).alias("learn"))
    cuts = cut_points(rows.filter("learn"))
    grown, state = grow(binned(rows, cuts), params, len(cuts), key, seed)
    forests = [as_forest(spark, trees, chosen, cuts, names) for trees, chosen in zip(grown, params, strict=True)]
    found = {r["trial_id"]: r for r in trial_metrics(state, len(params)).collect()}
    seconds = (time.monotonic() - started) / max(1, len(params))
    measured = [
        (n, p["max_depth"], p["learning_rate"], p["n_estimators"], p["subsample"], p["colsample_bytree"],
         *[None if n not in found or found[n][m] is None else float(found[n][m]) for m in ("f1", "recall", "roc_auc")], seconds)
        for n, p in enumerate(params)]
    return spark.createDataFrame(measured, TRIAL_SCHEMA), forests
