"""Scans, casts, profiles and the subscriber joins."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.operators import joins
from propensa.plans.ingest import join_subscribers, typed
from propensa.queries.twins import with_tables
from propensa.session import scratch_path, stored
from propensa.sources import schemas, standins, tables
from propensa.sources.registry import latest_artifacts

CRM_NAMES = ["subscribers", "tags", "transactions"]


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_subscribers(standins.crm_standins(spark, sf_dir))


@cache
def joined_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined table as the ingest step hands it over: written once, read by all later steps."""
    return stored(joined(spark, sf_dir))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def crm_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    crm = standins.crm_standins(spark, sf_dir)
    return _union([
        getattr(crm, name).agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in CRM_NAMES
    ])


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    crm = standins.crm_standins(spark, sf_dir)
    return _union([tables.profile(getattr(crm, name), name) for name in CRM_NAMES])


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined table written as CSV with a header and scanned back under its schema."""
    path = scratch_path(spark, "joined-csv")
    tables.write_table(joined_table(spark, sf_dir), path, "csv")
    return tables.read_table(spark, path, "csv", schemas.SUBSCRIBERS_JOINED)


def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions read as a named table, as a database query would."""
    standins.transactions(spark, sf_dir).createOrReplaceTempView("Transactions")
    return spark.sql("SELECT * FROM Transactions")


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest artifact per kind, the names made from the time stamps of the events."""
    names = standins.source(spark, sf_dir, "events").selectExpr(
        "event_type as kind", "concat(event_type, '_best_', date_format(ts, 'yyyyMMdd_HHmmss'), '.model') as name"
    )
    return latest_artifacts(names, by="kind")


QUERIES = {
    "crm_subscribers": standins.subscribers,
    "crm_tags": standins.tags,
    "crm_transactions": standins.transactions,
    "crm_views": crm_views,
    "table_profile": table_profile,
    "typed_subscribers": lambda s, d: typed(standins.crm_standins(s, d)).subscribers,
    "typed_transactions": lambda s, d: typed(standins.crm_standins(s, d)).transactions,
    "catalog_scan": catalog_scan,
    "csv_scan": csv_scan,
    "latest_version": latest_version,
    "tag_counts": lambda s, d: joins.tag_counts(standins.tags(s, d)),
    "purchase_flag": lambda s, d: joins.with_purchase_flag(
        standins.subscribers(s, d), standins.transactions(s, d)
    ).select("mailchimp_id", "user_email", "made_purchase"),
    "subscribers_joined": joined,
}

PROFILE_ROWS = [
    (name, position, field.name, field.dataType.simpleString())
    for name, schema in zip(CRM_NAMES, [schemas.SUBSCRIBERS_RAW, schemas.TAGS_RAW, schemas.TRANSACTIONS_RAW])
    for position, field in enumerate(schema.fields)
]

SQL = {
    "crm_subscribers": with_tables("subscribers") + "select * from subscribers",
    "crm_tags": with_tables("tags") + "select * from tags",
    "crm_transactions": with_tables("transactions") + "select * from transactions",
    "crm_views": with_tables(*CRM_NAMES) + " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count from {name}" for name in CRM_NAMES
    ),
    "table_profile": with_tables(*CRM_NAMES) + """,
        shapes as (""" + " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count from {name}" for name in CRM_NAMES
    ) + "), described(table_name, column_position, column_name, data_type) as (values " + ", ".join(
        f"('{table}', {position}, '{column}', '{dtype}')" for table, position, column, dtype in PROFILE_ROWS
    ) + """)
        select table_name, row_count,
               cast(count(*) over (partition by table_name) as int) as column_count,
               column_position, column_name, data_type
        from described join shapes using (table_name)""",
    "typed_subscribers": with_tables("subscribers")
    + "select * replace (cast(optin_time as timestamp) as optin_time) from subscribers",
    "typed_transactions": with_tables("transactions")
    + "select * replace (cast(purchased_at as timestamp) as purchased_at) from transactions",
    "catalog_scan": with_tables("transactions") + "select * from transactions",
    "csv_scan": with_tables("joined") + "select * from joined",
    "latest_version": """
        select kind, stamp, name from (
            select event_type as kind, strftime(ts, '%Y%m%d_%H%M%S') as stamp,
                   concat(event_type, '_best_', strftime(ts, '%Y%m%d_%H%M%S'), '.model') as name
            from events)
        group by kind, stamp, name
        qualify row_number() over (partition by kind order by stamp desc, name desc) = 1""",
    "tag_counts": with_tables("tags") + "select mailchimp_id, count(tag) as tag_count from tags group by 1",
    "purchase_flag": with_tables("joined") + "select mailchimp_id, user_email, made_purchase from joined",
    "subscribers_joined": with_tables("joined") + "select * from joined",
}
