"""Declarative quality checks over a table.

A suite is a list of ``Check`` values. All checks that look at one row at a time,
and all plain aggregates, are counted in a single pass; a uniqueness check adds
one grouped count. Null values are ignored by every column check but
``not_null``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensa.functions.features import sql_text

# Patterns of the checked text columns.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
COUNTRY_PATTERN = r"^[a-zA-Z]{2}$"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
NOT_EMPTY_PATTERN = r"^.+$"

SAMPLE_SIZE = 20

# Table-level checks answered from the schema, without a job.
SCHEMA_KINDS = ("column_count", "column_order", "type_is")
# Checks that mark single rows.
ROW_KINDS = ("not_null", "matches", "in_set", "between", "date_format")


@dataclass(frozen=True)
class Check:
    """One expectation; ``kind`` selects it and ``args`` holds its parameters."""

    kind: str
    column: str | None = None
    args: dict[str, Any] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return self.kind if self.column is None else f"{self.kind}({self.column})"


def row_count(low: int, high: int) -> Check:
    return Check("row_count", args={"low": low, "high": high})


def column_count(count: int) -> Check:
    return Check("column_count", args={"count": count})


def column_order(names: Sequence[str]) -> Check:
    return Check("column_order", args={"names": list(names)})


def unique(column: str) -> Check:
    return Check("unique", column)


def not_null(column: str) -> Check:
    return Check("not_null", column)


def matches(column: str, pattern: str) -> Check:
    return Check("matches", column, {"pattern": pattern})


def in_set(column: str, values: Sequence[Any]) -> Check:
    """Null is always allowed."""
    return Check("in_set", column, {"values": [v for v in values if v is not None]})


def between(column: str, low: float, high: float) -> Check:
    return Check("between", column, {"low": low, "high": high})


def type_is(column: str, dtype: str) -> Check:
    return Check("type_is", column, {"dtype": dtype})


def min_between(column: str, low: float, high: float) -> Check:
    return Check("min_between", column, {"low": low, "high": high})


def mean_between(column: str, low: float, high: float) -> Check:
    return Check("mean_between", column, {"low": low, "high": high})


def date_format(column: str) -> Check:
    """A real calendar date written as ``yyyy-MM-dd``."""
    return Check("date_format", column)


def share_at_most(column: str, share: float) -> Check:
    """No single value holds more than ``share`` of the non-null rows."""
    return Check("share_at_most", column, {"share": share})


def _literal(value: Any) -> str:
    return sql_text(value) if isinstance(value, str) else str(value)


def is_unexpected(check: Check) -> str:
    """SQL condition, never null, that is true on the rows that break a row check."""
    column, args = f"`{check.column}`", check.args
    text = f"cast({column} as string)"
    if check.kind == "not_null":
        return f"{column} is null"
    if check.kind == "matches":
        bad = f"not {text} rlike {sql_text(args['pattern'])}"
    elif check.kind == "in_set":
        allowed = ", ".join(_literal(v) for v in args["values"])
        bad = f"{column} not in ({allowed})" if allowed else "true"
    elif check.kind == "between":
        bad = f"{column} not between {args['low']} and {args['high']}"
    elif check.kind == "date_format":
        shape = f"{text} rlike {sql_text(DATE_PATTERN)}"
        bad = f"(not {shape} or try_to_timestamp({text}, 'yyyy-MM-dd') is null)"
    else:
        raise ValueError(f"{check.kind} does not mark rows")
    return f"({column} is not null and {bad})"


RESULT_FIELDS = (
    "position int, check string, column string, success boolean, observed double, "
    "element_count bigint, missing_count bigint, unexpected_count bigint, unexpected_percent double"
)

BASIC, SUMMARY, COMPLETE = "basic", "summary", "complete"


def _result(
    position: int, check: Check, success: str, observed: str = "null", elements: str = "null",
    missing: str = "null", unexpected: str = "null",
) -> str:
    """SQL struct of one result row."""
    column = "null" if check.column is None else sql_text(check.column)
    percent = f"100 * coalesce(try_divide({unexpected}, {elements} - {missing}), 0)" if unexpected != "null" else "null"
    values = [
        str(position), sql_text(check.name), column, success, observed, elements, missing, unexpected, percent,
    ]
    fields = [field.split() for field in RESULT_FIELDS.split(", ")]
    named = ", ".join(f"'{name}', cast({v} as {dtype})" for (name, dtype), v in zip(fields, values))
    return f"named_struct({named})"


def _schema_result(df: DataFrame, position: int, check: Check) -> str:
    if check.kind == "column_count":
        success = len(df.columns) == check.args["count"]
        return _result(position, check, str(success), observed=str(len(df.columns)))
    if check.kind == "column_order":
        return _result(position, check, str(df.columns == check.args["names"]))
    return _result(position, check, str(df.schema[check.column].dataType.simpleString() == check.args["dtype"]))


def _one_pass(df: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    """Results of every check that needs no grouping, from one aggregate."""
    measures = {"n_rows": "count(*)"}
    results = []
    for i, check in checks:
        args, missing = check.args, f"null_{check.column}"
        if check.column is not None and check.kind not in SCHEMA_KINDS:
            measures[missing] = f"count_if(`{check.column}` is null)"
        if check.kind in SCHEMA_KINDS:
            outcome = _schema_result(df, i, check)
        elif check.kind == "row_count":
            outcome = _result(i, check, f"n_rows between {args['low']} and {args['high']}", observed="n_rows")
        elif check.kind in ROW_KINDS:
            measures[f"bad_{i}"] = f"count_if({is_unexpected(check)})"
            outcome = _result(
                i, check, f"bad_{i} = 0", elements="n_rows", missing=f"`{missing}`", unexpected=f"bad_{i}"
            )
        else:
            function = "min" if check.kind == "min_between" else "avg"
            measures[f"seen_{i}"] = f"{function}(`{check.column}`)"
            success = f"coalesce(seen_{i} between {args['low']} and {args['high']}, false)"
            outcome = _result(i, check, success, f"seen_{i}", "n_rows", f"`{missing}`")
        results.append(outcome)
    counts = df.agg(*[F.expr(sql).alias(name) for name, sql in measures.items()])
    return counts.selectExpr(f"inline(array({', '.join(results)}))")


def _grouped(df: DataFrame, position: int, check: Check) -> DataFrame:
    """Result of a check on the counts of equal values."""
    known = f"`{check.column}` is not null"
    measured = df.groupBy(check.column).agg(F.count("*").alias("n")).selectExpr(
        "coalesce(sum(n), 0) as n_rows",
        f"coalesce(sum(n) filter (where not {known}), 0) as missing",
        f"coalesce(sum(n) filter (where {known} and n > 1), 0) as repeated",
        f"max(n) filter (where {known}) as largest",
    )
    if check.kind == "unique":
        outcome = _result(
            position, check, "repeated = 0", elements="n_rows", missing="missing", unexpected="repeated"
        )
    else:
        share = "try_divide(largest, n_rows - missing)"
        success = f"coalesce({share} <= {check.args['share']}, true)"
        outcome = _result(position, check, success, share, "n_rows", "missing")
    return measured.selectExpr(f"inline(array({outcome}))")


def validate(df: DataFrame, suite: str, checks: Sequence[Check], detail: str = BASIC) -> DataFrame:
    """One row per check with its verdict and counts.

    ``summary`` and ``complete`` detail add the most frequent unexpected values of each
    check on values (null for the others; a missing value has nothing to show);
    the rows themselves, of any number, come from ``failing_rows``.
    """
    numbered = list(enumerate(checks))
    grouped = [(i, c) for i, c in numbered if c.kind in ("unique", "share_at_most")]
    plain = [(i, c) for i, c in numbered if c.kind not in ("unique", "share_at_most")]
    frames = [_one_pass(df, plain)] if plain else []
    frames += [_grouped(df, i, c) for i, c in grouped]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    out = out.select(F.lit(suite).alias("suite"), *out.columns)
    if detail == BASIC:
        return out
    ranked = F.array_sort(F.collect_list(F.struct("rank", "value")))
    samples = (
        unexpected_values(df, checks)
        .groupBy("check")
        .agg(F.transform(ranked, lambda r: r["value"]).alias("partial_unexpected"))
    )
    return out.join(samples, "check", "left").select(*out.columns, "partial_unexpected")


def failing_rows(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All rows that break a row check or repeat a unique value, with the list of checks each breaks (full detail).

    Repeated values are counted by value and joined back, so no group of rows is gathered.
    """
    marked, unique_checks = df, [c for c in checks if c.kind == "unique"]
    for i, check in enumerate(unique_checks):
        keys = repeated_rows(df, [check.column]).select(F.col(check.column).alias(f"__value_{i}"), F.lit(True).alias(f"__twice_{i}"))
        marked = marked.join(keys, F.col(check.column) == F.col(f"__value_{i}"), "left").drop(f"__value_{i}")
    broken = [f"if({is_unexpected(c)}, {sql_text(c.name)}, null)" for c in checks if c.kind in ROW_KINDS]
    broken += [f"if(__twice_{i}, {sql_text(c.name)}, null)" for i, c in enumerate(unique_checks)]
    names = F.expr(f"array_compact(array({', '.join(broken)}))") if broken else F.array().cast("array<string>")
    out = marked.withColumn("failed_checks", names).filter(F.size("failed_checks") > 0)
    return out.drop(*[f"__twice_{i}" for i in range(len(unique_checks))])


def repeated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows; null keys do not count."""
    known = df
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    return known.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def unexpected_values(df: DataFrame, checks: Sequence[Check], sample: int = SAMPLE_SIZE) -> DataFrame:
    """The most frequent unexpected values of every check on values, ``sample`` per check (summary detail).

    Values are counted before they are ranked, and the rank filter is applied
    on both sides of the shuffle, so a check that fails on every row is no hot spot.
    """
    broken = [
        f"if({is_unexpected(c)}, struct({sql_text(c.name)}, cast(`{c.column}` as string)), null)"
        for c in checks if c.kind in ROW_KINDS and c.kind != "not_null"
    ]
    values = df.sparkSession.createDataFrame([], "check string, value string, n_rows bigint")
    if broken:
        values = (
            df.selectExpr(f"inline(array_compact(array({', '.join(broken)}))) as (check, value)")
            .groupBy("check", "value")
            .agg(F.count("*").alias("n_rows"))
        )
    for check in checks:
        if check.kind == "unique":
            repeated = repeated_rows(df, [check.column])
            values = values.unionByName(repeated.select(
                F.lit(check.name).alias("check"), F.col(check.column).cast("string").alias("value"), "n_rows"))
    order = Window.partitionBy("check").orderBy(F.desc("n_rows"), F.asc("value"))
    return values.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample)


def verdicts(results: DataFrame) -> DataFrame:
    """One row per suite, and one for all suites together."""
    return (
        results.rollup("suite")
        .agg(F.every("success").alias("success"), F.count("*").alias("checks"),
             F.count_if(~F.col("success")).alias("failed"),
             F.expr("100 * count_if(success) / count(*)").alias("success_percent"))
        .withColumn("suite", F.coalesce("suite", F.lit("overall")))
    )


class QualityError(ValueError):
    """A quality suite failed."""

    def __init__(self, failures: list[str]):
        super().__init__("failed checks: " + ", ".join(failures))
        self.failures = failures


def gate(results: DataFrame) -> None:
    """Stop when a check failed. Results hold one row per declared check, so this reads few rows."""
    failed = results.filter(~F.col("success")).select("suite", "check").orderBy("suite", "check").collect()
    if failed:
        raise QualityError([f"{r['suite']}: {r['check']}" for r in failed])


def write_results(results: DataFrame, path: str) -> None:
    results.coalesce(1).write.mode("overwrite").json(path)
