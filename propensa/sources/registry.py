"""Fitted models and the table that lists them."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the time stamp inside an artifact name.
STAMP_PATTERN = r"(\d{8}_\d{6})"
STAMP_FORMAT = "%Y%m%d_%H%M%S"

ENTRY_SCHEMA = (
    "model_id string, stamp string, model_type string, path string, features array<string>, "
    "fields array<string>, reference_date string, params string, metrics string, "
    "training_samples bigint, validation_samples bigint, search_algorithm string"
)


def stamp_of(name: str) -> Any:
    """Time stamp inside an artifact name, empty when there is none."""
    return F.regexp_extract(name, STAMP_PATTERN, 1)


def latest_artifacts(names: DataFrame, name: str = "name", by: str | None = None) -> DataFrame:
    """Newest artifact (per ``by`` group) by the stamp in its name; names without one do not count."""
    stamped = names.withColumn("stamp", stamp_of(name)).filter(F.col("stamp") != "")
    keys = [by] if by else []
    newest = F.max(F.struct("stamp", name))
    return stamped.groupBy(*keys).agg(newest.alias("newest")).select(*keys, "newest.*").filter(
        F.col("stamp").isNotNull()
    )


@dataclass(frozen=True)
class ScoringModel:
    """A saved pipeline from raw lead fields to a probability, with its description."""

    pipeline: PipelineModel
    features: list[str]
    fields: list[str]
    metadata: dict[str, Any]


class ModelRegistry:
    """Folder with one sub-folder per model and an appended table of entries."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    @property
    def _table(self) -> str:
        return f"{self.folder}/entries"

    def register(
        self,
        pipeline: PipelineModel,
        features: list[str],
        fields: list[str],
        reference_date: datetime,
        params: dict[str, Any],
        metrics: dict[str, Any],
        training_samples: int,
        validation_samples: int,
        model_type: str = "gbt",
        search_algorithm: str = "Random Search",
        now: datetime | None = None,
    ) -> str:
        """Save the pipeline and append its entry; returns the model id."""
        stamp = (now or datetime.now()).strftime(STAMP_FORMAT)
        model_id = f"{model_type}_best_{stamp}"
        path = f"{self.folder}/models/{model_id}"
        pipeline.write().overwrite().save(path)
        entry = (
            model_id, stamp, model_type, path, features, fields, reference_date.isoformat(), json.dumps(params),
            json.dumps(metrics), training_samples, validation_samples, search_algorithm,
        )
        self.spark.createDataFrame([entry], ENTRY_SCHEMA).write.mode("append").json(self._table)
        return model_id

    def entries(self) -> DataFrame:
        return self.spark.read.schema(ENTRY_SCHEMA).json(self._table)

    def latest(self) -> DataFrame:
        """Entry of the newest model: one row."""
        newest = F.max_by(F.struct("*"), F.struct("stamp", "model_id"))
        return self.entries().agg(newest.alias("e")).select("e.*").filter(F.col("model_id").isNotNull())

    def load(self, model_id: str | None = None) -> ScoringModel:
        """A model by id, or the newest."""
        rows = self.latest() if model_id is None else self.entries().filter(F.col("model_id") == model_id)
        row = rows.first()
        if row is None:
            raise FileNotFoundError(f"no model {model_id or ''} in {self.folder}")
        metadata = row.asDict()
        for name in ("params", "metrics"):
            metadata[name] = json.loads(metadata[name])
        return ScoringModel(PipelineModel.load(row["path"]), row["features"], row["fields"], metadata)
