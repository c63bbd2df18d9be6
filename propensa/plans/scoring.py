"""Batch scoring of leads with a fitted model."""

from __future__ import annotations

import re

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.operators.columns import MissingColumns
from propensa.operators.quality import EMAIL_PATTERN
from propensa.sources.registry import ScoringModel

# Length bounds of a looked-up email.
EMAIL_LENGTH = (5, 100)


def score(model: ScoringModel, leads: DataFrame) -> DataFrame:
    """All lead columns with ``prediction_proba`` and ``prediction`` added; the email stays in its row."""
    absent = set(model.fields) - set(leads.columns)
    if absent:
        raise MissingColumns(list(absent))
    out = model.pipeline.transform(leads)
    return out.select(
        *leads.columns,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("prediction_proba"),
    )


def score_leads(model: ScoringModel, leads: DataFrame) -> DataFrame:
    """Purchase probability per lead, works on batch and streaming frames alike."""
    return score(model, leads).select("user_email", "prediction_proba")


# Row groups of this size: a lookup reads few of them, a scan still reads large stretches.
LOOKUP_GROUP_BYTES = 4 * 1024**2
LOOKUP_GROUP_ROWS = 20_000


def write_lookup(
    leads: DataFrame, path: str, key: str = "mailchimp_id", email: str = "user_email", group_bytes: int = LOOKUP_GROUP_BYTES,
    group_rows: int = LOOKUP_GROUP_ROWS,
) -> None:
    """Leads laid out for finding one: in ranges of the key, sorted by it, with bloom filters on key and email.

    A key is in the bounds of one or two row groups; an email is in the bounds of most, and the filters rule out all but
    its own and about one in a hundred of the others.
    """
    bloom = {f"parquet.bloom.filter.{what}#{column}": value for column in (key, email)
             for what, value in (("enabled", "true"), ("expected.ndv", str(group_rows)))}
    ranged = leads.repartitionByRange(key).sortWithinPartitions(key)
    ranged.write.options(**bloom, **{"parquet.block.size": str(group_bytes), "parquet.block.row.count.limit": str(group_rows)}).parquet(path)


def lookup(spark: SparkSession, path: str, column: str, value: int | str) -> DataFrame:
    """The leads with this value. The comparison is pushed to the reader, which skips row groups by bounds and bloom filters."""
    return spark.read.parquet(path).filter(F.col(column) == F.lit(value))


def score_by_email(model: ScoringModel, leads: DataFrame, email: str) -> DataFrame:
    """Score of one email. The filter comes before the features, so it reaches the scan."""
    low, high = EMAIL_LENGTH
    if not (low <= len(email) <= high and re.match(EMAIL_PATTERN, email)):
        raise ValueError(f"not an email address: {email!r}")
    return score_leads(model, leads.filter(F.col("user_email") == email))


def score_by_id(model: ScoringModel, leads: DataFrame, lead_id: int, key: str = "mailchimp_id") -> DataFrame:
    """Score of one subscriber id, which must be positive."""
    if lead_id <= 0:
        raise ValueError(f"lead id must be positive: {lead_id}")
    return score(model, leads.filter(F.col(key) == lead_id)).select(
        F.col(key).alias("lead_id"), "prediction_proba"
    )
