"""Scoring of leads as they arrive, as a stateless Structured Streaming query."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from propensa.plans.prepare import add_features
from propensa.plans.scoring import score_leads
from propensa.sources.registry import ScoringModel

def lead_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", max_bytes: int | None = None, max_files: int | None = None
) -> DataFrame:
    """Leads from files dropped into a folder; a micro-batch is bounded in bytes or files only if asked for."""
    if max_bytes is not None and max_files is not None:
        raise ValueError("bound a micro-batch in bytes or in files")
    bounds = {"maxBytesPerTrigger": max_bytes, "maxFilesPerTrigger": max_files}
    given = {name: bound for name, bound in bounds.items() if bound is not None}
    return spark.readStream.schema(schema).format(fmt).options(**given).load(path)


def kafka_lead_stream(
    spark: SparkSession, servers: str, topic: str, schema: StructType, max_records: int | None = None
) -> DataFrame:
    """Leads from JSON messages, at most ``max_records`` per micro-batch if given; needs the Kafka connector on the class path."""
    from pyspark.sql import functions as F

    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    messages = (reader if max_records is None else reader.option("maxOffsetsPerTrigger", max_records)).load()
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("lead")).select("lead.*")


def start_scoring(
    model: ScoringModel, leads: DataFrame, out_path: str, checkpoint_path: str, fmt: str = "parquet"
) -> StreamingQuery:
    """Score all leads that are available now and stop."""
    return start_appending(score_leads(model, leads), out_path, checkpoint_path, fmt)


def start_features(
    leads: DataFrame, reference_date: datetime, out_path: str, checkpoint_path: str, fmt: str = "parquet"
) -> StreamingQuery:
    """Engineer the features of all leads that are available now and stop.

    The reference date must be given: a stream has no latest date.
    """
    return start_appending(add_features(leads, reference_date), out_path, checkpoint_path, fmt)


def start_appending(rows: DataFrame, out_path: str, checkpoint_path: str, fmt: str = "parquet") -> StreamingQuery:
    """Append what is available now to a table; a restart continues after the last batch."""
    return (
        rows.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start(out_path)
    )
