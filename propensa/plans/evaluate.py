"""Evaluation of a fitted model on held-out leads."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensa.operators import metrics as mx
from propensa.plans.learning import TARGET, evaluate_scores, feature_importance
from propensa.plans.scoring import score
from propensa.session import stored
from propensa.sources.registry import ScoringModel

TOP_PRINTED = 10
TOP_CHARTED = 15


@dataclass(frozen=True)
class Evaluation:
    """Everything measured on one test set."""

    metrics: dict[str, Any]
    report: DataFrame
    confusion: DataFrame
    roc: DataFrame
    pr: DataFrame
    importance: DataFrame
    test_set_size: int


def evaluate(model: ScoringModel, leads: DataFrame, target: str = TARGET) -> Evaluation:
    """Score the leads once and read every metric from the written scores."""
    table = stored(
        score(model, leads).select(
            F.col(target).cast("int").alias("label"), "prediction", F.col("prediction_proba").alias("score")
        )
    )
    return Evaluation(
        metrics=evaluate_scores(table),
        report=mx.classification_report(table),
        confusion=mx.confusion_matrix(table),
        roc=mx.roc_curve(table),
        pr=mx.pr_curve(table),
        importance=feature_importance(model.pipeline.stages[-1], model.features, leads.sparkSession),
        test_set_size=table.count(),
    )


def report_row(model: ScoringModel, result: Evaluation, now: datetime | None = None) -> DataFrame:
    """The evaluation report as one row of JSON fields."""
    spark = result.report.sparkSession
    importance = [r.asDict() for r in result.importance.collect()]
    row = (
        (now or datetime.now()).isoformat(),
        model.metadata["path"],
        json.dumps(model.metadata),
        json.dumps({**result.metrics, "feature_importance": importance}),
        result.test_set_size,
    )
    return spark.createDataFrame(
        [row],
        "evaluation_timestamp string, model_path string, model_metadata string, "
        "evaluation_results string, test_set_size bigint",
    )


def write_report(model: ScoringModel, result: Evaluation, folder: str) -> None:
    """The report, and the tables its charts are drawn from, under one folder."""
    report_row(model, result).write.mode("overwrite").json(f"{folder}/evaluation_report")
    result.report.write.mode("overwrite").json(f"{folder}/classification_report")
    result.confusion.write.mode("overwrite").json(f"{folder}/confusion_matrix")
    result.roc.write.mode("overwrite").parquet(f"{folder}/roc_curve")
    result.pr.write.mode("overwrite").parquet(f"{folder}/precision_recall_curve")
    result.importance.limit(TOP_CHARTED).write.mode("overwrite").json(f"{folder}/feature_importance")
