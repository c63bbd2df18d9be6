"""CRM tables derived from the order, customer and event tables of the test star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from propensa.functions.features import sql_list
from propensa.sources.tables import CrmTables

# Fixed values the stand-in tables are defined by.
COUNTRIES = [
    "us", "in", "au", "uk", "br", "ca", "de", "fr", "es", "mx", "nl", "sg", "dk",
    "pl", "my", "ae", "co", "id", "ng", "jp", "be", "it", "gb", "se", "ch",
]
DOMAINS = [
    "gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com", "acme.io", "corp.example",
]
CHARGE_COUNTRIES = ["US", "CA", "GB", "AU", "DE", "FR", "NZ"]
ACCOUNT_ORDERS = 24  # every so many orders, one carries the account's email; the others are made as guests

# Columns read from each table. A stated schema saves a pass over the file footers.
SOURCES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double",
    "events": "ts timestamp_ntz, user_id bigint, event_type string, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: str) -> str:
    """The value at a 0-based index, null beyond the list."""
    return f"get(array({sql_list(values)}), cast({index} as int))"


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "customer").selectExpr(
        "c_custkey as mailchimp_id",
        "c_name as user_full_name",
        f"concat(lower(replace(c_name, '#', '.')), '@', {_pick(DOMAINS, 'c_custkey % 7')}) as user_email",
        "cast(least(5, 1 + floor((c_acctbal + 1000) / 2200)) as int) as member_rating",
        "cast(date_add(date'2015-01-01', cast(c_custkey * 37 % 1461 as int)) as string) as optin_time",
        f"{_pick(COUNTRIES, 'c_nationkey')} as country_code",
    )


def event_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tag per event, repeats included."""
    number = "cast(cast(get_json_object(props, '$.k') as int) % 10 as string)"
    return source(spark, sf_dir, "events").selectExpr(
        "user_id as mailchimp_id", f"concat(event_type, '-', lpad({number}, 2, '0')) as tag"
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_tags(spark, sf_dir).distinct()


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = "lpad(cast(o_custkey as string), 9, '0')"
    return (
        source(spark, sf_dir, "orders")
        .selectExpr(
            "o_orderkey as transaction_id",
            "cast(cast(o_orderdate as date) as string) as purchased_at",
            f"concat('Customer#', {padded}) as user_full_name",
            f"if(o_orderkey % {ACCOUNT_ORDERS} = 0, concat('customer.', {padded}, '@', {_pick(DOMAINS, 'o_custkey % 7')}), "
            f"concat('guest.', o_orderkey, '@', {_pick(DOMAINS, 'o_orderkey % 7')})) as user_email",
            f"{_pick(CHARGE_COUNTRIES, 'o_custkey % 8')} as charge_country",
            "cast(1 + o_orderkey % 100 as int) as product_id",
        )
    )


def crm_standins(spark: SparkSession, sf_dir: str) -> CrmTables:
    return CrmTables(
        subscribers=subscribers(spark, sf_dir),
        tags=tags(spark, sf_dir),
        transactions=transactions(spark, sf_dir),
    )
