"""Table scans and sinks: parquet, CSV, JSON, JDBC and catalog tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from propensa.functions.features import sql_text
from propensa.sources import schemas


@dataclass(frozen=True)
class CrmTables:
    """The three CRM tables as scanned."""

    subscribers: DataFrame
    tags: DataFrame
    transactions: DataFrame


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """Scan a file table. CSV and JSON need a schema: inferring one costs a pass and may drift."""
    reader = spark.read
    if fmt in ("csv", "json"):
        if schema is None:
            raise ValueError(f"a {fmt} scan needs an explicit schema")
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


@dataclass(frozen=True)
class Split:
    """How the scan of a database table is cut into ranges: a numeric key, its bounds, the number of ranges."""

    key: str
    low: int
    high: int
    partitions: int = 64

    @classmethod
    def parse(cls, text: str) -> tuple[str, Split]:
        """``TABLE:KEY:LOW:HIGH`` or ``TABLE:KEY:LOW:HIGH:PARTITIONS``."""
        table, key, *numbers = text.split(":")
        if not key or len(numbers) not in (2, 3):
            raise ValueError(f"{text!r} is not TABLE:KEY:LOW:HIGH[:PARTITIONS]")
        return table, cls(key, *map(int, numbers))


def read_jdbc(spark: SparkSession, url: str, table: str, split: Split, fetch_size: int = 10_000, **options: str) -> DataFrame:
    """Scan a database table by ranges of a key: one connection and one task for each, read in blocks of ``fetch_size`` rows."""
    return (
        spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
        .option("partitionColumn", split.key)
        .option("lowerBound", split.low)
        .option("upperBound", split.high)
        .option("numPartitions", split.partitions)
        .option("fetchsize", fetch_size)
        .load()
    )


def crm_from_files(spark: SparkSession, folder: str, fmt: str = "parquet") -> CrmTables:
    """CRM tables stored as ``subscribers``, ``tags`` and ``transactions`` under one folder."""
    return CrmTables(
        subscribers=read_table(spark, f"{folder}/subscribers", fmt, schemas.SUBSCRIBERS_RAW),
        tags=read_table(spark, f"{folder}/tags", fmt, schemas.TAGS_RAW),
        transactions=read_table(spark, f"{folder}/transactions", fmt, schemas.TRANSACTIONS_RAW),
    )


def crm_from_catalog(spark: SparkSession, database: str | None = None) -> CrmTables:
    """CRM tables registered in the session catalog under their source names."""
    prefix = f"{database}." if database else ""
    return CrmTables(
        subscribers=spark.table(f"{prefix}Subscribers"),
        tags=spark.table(f"{prefix}Tags"),
        transactions=spark.table(f"{prefix}Transactions"),
    )


def crm_from_jdbc(spark: SparkSession, url: str, splits: dict[str, Split], **options: str) -> CrmTables:
    """CRM tables in a database; ``splits`` holds how each of the three is cut."""
    names = ["Subscribers", "Tags", "Transactions"]
    if missing := [n for n in names if n not in splits]:
        raise ValueError(f"no split key and bounds for {', '.join(missing)}: the whole table would be one task")
    return CrmTables(*[read_jdbc(spark, url, n, splits[n], **options) for n in names])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Overwrite a file table. Parquet is the hand-over format between steps."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def cast_columns(df: DataFrame, casts: dict[str, str], lenient: bool = False) -> DataFrame:
    """Cast the named columns in one projection; a bad value raises unless ``lenient``."""
    convert = "try_cast" if lenient else "cast"
    return df.withColumns({
        name: F.expr(f"{convert}(`{name}` as {dtype})") for name, dtype in casts.items() if name in df.columns
    })


def profile(df: DataFrame, table_name: str) -> DataFrame:
    """Shape and column list of a table: one row per column, with row and column counts."""
    described = ", ".join(
        f"struct({position}, {sql_text(name)}, {sql_text(dtype)})" for position, (name, dtype) in enumerate(df.dtypes)
    )
    return df.agg(F.count("*").alias("row_count")).selectExpr(
        f"{sql_text(table_name)} as table_name",
        "row_count",
        f"{len(df.columns)} as column_count",
        f"inline(array({described})) as (column_position, column_name, data_type)",
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first few rows, as a report."""
    return df.limit(rows)
