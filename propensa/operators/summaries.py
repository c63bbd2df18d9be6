"""Grouped rates, shares, quantiles and counts over joined subscribers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensa.functions.features import email_domain, sql_text
from propensa.operators.running import Running, running_totals

TARGET = "made_purchase"


def pareto(
    df: DataFrame,
    group: str,
    target: str = TARGET,
    min_sales: int | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Sales and rate per group, share of all sales, and the running share from the top seller.

    Equal sales are ordered by the group itself. Shares cover all groups; only
    then are groups with ``min_sales`` or fewer dropped. Null groups do not count.
    """
    grouped = (
        df.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.sum(target).alias("sales"), F.count("*").alias("__n"))
        .withColumn("__down", -F.col("sales"))
    )
    run = running_totals(
        grouped,
        order=["__down", group],
        what=Running(sums={"__cum": "sales"}, totals={"__total": "sales"}),
        ranges=ranges,
    )
    shares = run.select(
        group,
        "sales",
        (F.col("sales") / F.col("__n")).alias("prop_in_group"),
        F.try_divide("sales", "__total").alias("prop_overall"),
        F.try_divide("__cum", "__total").alias("prop_cumsum"),
    )
    return shares if min_sales is None else shares.filter(F.col("sales") > min_sales)


def grouped_rate(df: DataFrame, group: Column, name: str, target: str = TARGET) -> DataFrame:
    """Count, sum and mean of the target per group; null groups do not count."""
    return (
        df.select(group.alias(name), F.col(target).alias("__y"))
        .filter(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count("__y").alias("count"), F.sum("__y").alias("sum"), F.avg("__y").alias("mean"))
    )


def monthly_conversion(df: DataFrame, time: str = "optin_time", target: str = TARGET) -> DataFrame:
    return grouped_rate(df, F.month(time), "optin_month", target)


def domain_performance(df: DataFrame, email: str = "user_email", target: str = TARGET) -> DataFrame:
    """Conversion by email domain, most frequent domain first."""
    rates = grouped_rate(df, F.expr(email_domain(email)), "email_domain", target)
    return rates.orderBy(F.desc("count"), "email_domain")


def top_domains(df: DataFrame, n: int = 5, email: str = "user_email", target: str = TARGET) -> DataFrame:
    return domain_performance(df, email, target).limit(n)


def conversion_rate(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.agg(F.avg(target).alias("conversion_rate"))


def target_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows and share of all rows per target value, nulls left out."""
    counts = df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count("*").alias("count"))
    run = running_totals(counts, [target], Running(sums={}, totals={"__all": "count"}))
    return run.select(target, "count", (F.col("count") / F.col("__all")).alias("proportion"))


def group_quantiles(
    df: DataFrame,
    group: str,
    value: str,
    quantiles: Sequence[float] = (0.10, 0.50, 0.90),
    approximate: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Quantiles of ``value`` per group, interpolated between neighbours.

    The exact form counts equal values first, then finds the rows on both sides
    of each position from running counts, so no group is gathered in one place.
    The approximate form returns actual values from a mergeable sketch.
    """
    rows = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    if approximate:
        found = rows.groupBy(group).agg(F.percentile_approx(value, list(quantiles), 10_000).alias("__v"))
        return found.select(group, _long(quantiles, [F.col("__v")[i] for i in range(len(quantiles))]))\
            .select(group, "q.*")

    run = running_totals(
        rows.groupBy(group, value).agg(F.count("*").alias("__n")),
        order=[value],
        what=Running(sums={"__upto": "__n"}, totals={"__all": "__n"}),
        groups=[group],
        ranges=ranges,
    )
    last = F.col("__all") - 1

    def value_at(position: Column) -> Column:
        inside = (F.col("__upto") > position) & (F.col("__upto") - F.col("__n") <= position)
        return F.max(F.when(inside, F.col(value)))

    ends = run.groupBy(group).agg(
        F.max(last).alias("__last"),
        *[value_at(F.floor(last * q)).alias(f"__lo{i}") for i, q in enumerate(quantiles)],
        *[value_at(F.ceil(last * q)).alias(f"__hi{i}") for i, q in enumerate(quantiles)],
    )
    results = []
    for i, q in enumerate(quantiles):
        position = F.col("__last") * F.lit(float(q))
        low, high = F.col(f"__lo{i}").cast("double"), F.col(f"__hi{i}").cast("double")
        results.append(low + (high - low) * (position - F.floor(position)))
    return ends.select(group, _long(quantiles, results)).select(group, "q.*")


def _long(quantiles: Sequence[float], values: list[Column]) -> Column:
    """One row per quantile."""
    pairs = [
        F.struct(F.lit(float(q)).alias("quantile"), v.cast("double").alias("value"))
        for q, v in zip(quantiles, values)
    ]
    return F.explode(F.array(*pairs)).alias("q")


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, all counted in one pass; NaN counts as missing."""
    def missing(name: str, dtype: str) -> str:
        nan = f" or isnan(`{name}`)" if dtype in ("double", "float") else ""
        return f"count_if(`{name}` is null{nan})"

    counts = [f"struct({sql_text(name)}, {missing(name, dtype)})" for name, dtype in df.dtypes]
    return df.selectExpr(f"array({', '.join(counts)}) as counts").selectExpr(
        "inline(counts) as (column_name, null_count)"
    )
