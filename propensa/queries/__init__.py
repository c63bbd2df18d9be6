"""Named queries over the test star schema, each with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from propensa.queries import classifiers, crm, evaluation, leads, models, quality, reasons, summaries

Query = Callable[[SparkSession, str], DataFrame]

MODULES = [crm, summaries, leads, quality, evaluation, models, reasons, classifiers]


def queries() -> dict[str, Query]:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for module in MODULES for name, text in module.SQL.items()}
