"""Whole-table column steps: drop, align, fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from propensa.functions.names import TAG_PREFIX

# Columns the learner does not see, and its stand-in for a missing number.
NOT_FEATURES = ["mailchimp_id", "user_full_name", "user_email", "optin_time", "email_provider"]
MISSING = -999


class MissingColumns(ValueError):
    """The input lacks columns the model was fitted on."""

    def __init__(self, names: Sequence[str]):
        super().__init__(f"input lacks expected columns: {sorted(names)}")
        self.names = sorted(names)


def drop_columns(df: DataFrame, names: Sequence[str] = NOT_FEATURES) -> DataFrame:
    """Drop the listed columns that are present."""
    return df.drop(*names)


def align(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The feature columns in their fitted order, after the ``keep`` columns."""
    absent = set(features) - set(df.columns)
    if absent:
        raise MissingColumns(list(absent))
    return df.select(*keep, *[f for f in features if f not in keep])


def tag_names(df: DataFrame) -> list[str]:
    """Columns that start with the tag prefix (the tag count included)."""
    return [c for c in df.columns if c.startswith(TAG_PREFIX)]


def text_columns(df: DataFrame, skip: Sequence[str] = ("user_email",)) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]


def fill_tags(df: DataFrame) -> DataFrame:
    """Missing tag values become 0."""
    return df.fillna(0, subset=tag_names(df))


def fill_missing(df: DataFrame, value: int = MISSING) -> DataFrame:
    """Missing (or NaN) numbers become ``value``; each column keeps its type."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.fillna(value, subset=numeric)
