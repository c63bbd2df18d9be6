"""Label codes: text values to their 0-based position in sorted order.

The fitted codes are a table, not a driver-side list, so a column with very
many distinct values is encoded by the same join as one with a few. Catalyst
broadcasts the table when its written size is small and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.operators.running import Running, running_totals
from propensa.session import stored

# Fixed value: the text a missing value is encoded as.
MISSING_TEXT = "nan"


class NotFitted(ValueError):
    """Codes were asked for without fitted encoders."""


def as_text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(MISSING_TEXT))


@dataclass(frozen=True)
class Encoders:
    """Fitted codes of several columns: a table of (column_name, value, code) per column."""

    codes: dict[str, DataFrame]

    @property
    def columns(self) -> list[str]:
        return list(self.codes)

    def table(self) -> DataFrame:
        """All codes in one table."""
        frames = [df.select(F.lit(c).alias("column_name"), "value", "code") for c, df in self.codes.items()]
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out

    def save(self, path: str) -> None:
        self.table().write.mode("overwrite").partitionBy("column_name").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Encoders:
        table = spark.read.parquet(path)
        names = [r["column_name"] for r in table.select("column_name").distinct().collect()]
        return Encoders.of(table, sorted(names))

    @staticmethod
    def of(table: DataFrame, columns: Sequence[str]) -> Encoders:
        """Encoders in a written table that is partitioned by column."""
        return Encoders({
            c: table.filter(F.col("column_name") == c).select("value", "code") for c in columns
        })


def fit_encoders(df: DataFrame, columns: Sequence[str], ranges: int | None = None) -> Encoders:
    """Codes of all the columns, from one pass over ``df``."""
    if not columns:
        return Encoders({})
    values = (
        df.select(F.explode(F.create_map(*[x for c in columns for x in (F.lit(c), as_text(c))])))
        .toDF("column_name", "value")
        .distinct()
        .withColumn("__one", F.lit(1))
    )
    run = running_totals(
        values, ["value"], Running(sums={"__rank": "__one"}), ["column_name"], ranges=ranges
    )
    code = (F.col("__rank") - 1).cast("int").alias("code")
    return Encoders.of(stored(run.select("value", code, "column_name"), partition_by="column_name"), columns)


def fit_codes(df: DataFrame, column: str, ranges: int | None = None) -> DataFrame:
    """Table of (value, code) in sorted order of the distinct values."""
    return fit_encoders(df, [column], ranges).codes[column]


def apply_codes(df: DataFrame, column: str, codes: DataFrame, unseen: str = "error") -> DataFrame:
    """Replace ``column`` by its code. A value not in the codes raises, or with ``unseen="keep"``
    gets the code after the last one."""
    if unseen not in ("error", "keep"):
        raise ValueError(f"unseen must be 'error' or 'keep', not {unseen!r}")
    lookup = codes.select(F.col("value").alias("__value"), F.col("code").alias("__code"))
    text = as_text(column)
    if unseen == "error":
        message = F.concat(F.lit(f"unseen value in {column}: "), text)
        fallback = F.raise_error(message).cast("int")
    else:
        fallback = codes.agg((F.coalesce(F.max("code"), F.lit(-1)) + 1).alias("next")).scalar().cast("int")
    return (
        df.join(lookup, text == lookup["__value"], "left")
        .withColumn(column, F.coalesce("__code", fallback))
        .drop("__value", "__code")
    )


def apply_encoders(
    df: DataFrame, columns: Sequence[str], encoders: Encoders | None, unseen: str = "error"
) -> tuple[DataFrame, list[str]]:
    """Encode the columns that have fitted codes; the others are returned as skipped."""
    if encoders is None:
        raise NotFitted("fitted encoders are needed to apply codes")
    skipped = [c for c in columns if c not in encoders.codes]
    for column in columns:
        if column in encoders.codes:
            df = apply_codes(df, column, encoders.codes[column], unseen)
    return df, skipped


def ordinal(column: str, order: Sequence[str]) -> Column:
    """0-based position in a given order; values outside it raise."""
    text = F.col(column).cast("string")
    position = F.array_position(F.array(*[F.lit(v) for v in order]), text)
    message = F.concat(F.lit(f"value of {column} outside its order: "), text)
    return (
        F.when(text.isNull(), F.lit(None).cast("int"))
        .when(position == 0, F.raise_error(message).cast("int"))
        .otherwise((position - 1).cast("int"))
    )
