"""Joined subscribers to engineered leads and to the model matrix."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensa.functions import features as fx
from propensa.operators.columns import drop_columns, fill_missing, fill_tags, text_columns
from propensa.operators.encode import Encoders, apply_encoders, fit_encoders
from propensa.operators.pivot import tag_pivot, with_tags

TARGET = "made_purchase"
KEY = "mailchimp_id"
MATRIX_CODES = ["country_code"]
REFERENCE = "__reference"


@dataclass(frozen=True)
class Prepared:
    """Engineered leads with the encoders fitted on, or applied to, them."""

    leads: DataFrame
    encoders: Encoders
    skipped: list[str]


def merge_tags(
    joined: DataFrame, tags: DataFrame, vocabulary: list[str] | None = None, strict: bool = True
) -> DataFrame:
    """Joined subscribers with one 0/1 column per tag, null where a subscriber has no tags."""
    typed = tags.withColumn(KEY, F.col(KEY).cast("bigint"))
    wide = tag_pivot(typed, vocabulary, KEY, strict, taken=[c for c in joined.columns if c != KEY])
    return with_tags(joined, wide, KEY)


def add_dates(df: DataFrame, reference_date: datetime | None = None, time: str = "optin_time") -> DataFrame:
    """Calendar features of the opt-in time, in days from the reference date.

    Without a date the latest time of the batch is used, from a one-row subquery.
    Scoring passes the date the model was fitted with instead, in the time zone of the session.
    """
    timed = df.withColumn(time, F.col(time).cast("timestamp"))
    if reference_date is None:
        reference: Column = timed.agg(F.max(time).alias("latest")).scalar()
    else:
        reference = F.expr(fx.timestamp_sql(reference_date))
    expressions = {name: F.expr(sql) for name, sql in fx.date_features(time, REFERENCE).items()}
    return timed.withColumn(REFERENCE, reference).withColumns(expressions).drop(REFERENCE)


def add_email(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.expr(sql) for name, sql in fx.email_features().items()})


def add_activity(df: DataFrame) -> DataFrame:
    return df.withColumn("tag_count_by_optin_day", F.expr(fx.tag_rate()))


def standardize_country(df: DataFrame) -> DataFrame:
    return df.withColumn("country_code", F.expr(fx.standard_country()))


def add_features(df: DataFrame, reference_date: datetime | None = None) -> DataFrame:
    """All engineered columns whose inputs are present; text columns stay text."""
    if "optin_time" in df.columns:
        df = add_dates(df, reference_date)
    if "user_email" in df.columns:
        df = add_email(df)
    if "tag_count" in df.columns and "optin_days" in df.columns:
        df = add_activity(df)
    if "country_code" in df.columns:
        df = standardize_country(df)
    return fill_tags(df)


def prepare_leads(
    df: DataFrame,
    encoders: Encoders | None = None,
    fit: bool = True,
    reference_date: datetime | None = None,
    unseen: str = "error",
) -> Prepared:
    """Engineered leads with every text column but the email replaced by its code."""
    engineered = add_features(df, reference_date)
    columns = text_columns(engineered)
    if fit:
        encoders = fit_encoders(engineered, columns)
    leads, skipped = apply_encoders(engineered, columns, encoders, unseen)
    return Prepared(leads, encoders, skipped)


def model_matrix(engineered: DataFrame, encoders: Encoders | None = None) -> tuple[DataFrame, Encoders]:
    """Numeric feature columns and the target: identifiers dropped, country coded once, gaps filled."""
    kept = drop_columns(engineered)
    if encoders is None:
        encoders = fit_encoders(kept, MATRIX_CODES)
    coded, _ = apply_encoders(kept, MATRIX_CODES, encoders)
    return fill_missing(coded), encoders


def feature_names(matrix: DataFrame, target: str = TARGET) -> list[str]:
    return [c for c in matrix.columns if c != target]
