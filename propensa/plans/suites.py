"""The quality suites of the CRM tables, the joined table and the business rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensa.functions.features import email_domain
from propensa.operators import quality as q
from propensa.sources.schemas import SUBSCRIBERS_JOINED_COLUMNS, SUBSCRIBERS_RAW, TAGS_RAW, TRANSACTIONS_RAW

# Row bounds per table and the allowed codes.
SUBSCRIBER_ROWS = (1000, 50000)
TAG_ROWS = (1000, 100000)
TRANSACTION_ROWS = (1000, 20000)
JOINED_ROWS = (1000, 50000)
SUBSCRIBER_COUNTRIES = ["us", "ca", "gb", "au", "de", "fr", "in", "it", "co", None]
CHARGE_COUNTRIES = ["US", "CA", "GB", "AU", "DE", "FR", "NZ", None]
CONVERSION_RANGE = (0.01, 0.5)
MAX_DOMAIN_SHARE = 0.9


def subscribers_suite(rows: tuple[int, int] = SUBSCRIBER_ROWS) -> list[q.Check]:
    return [
        q.row_count(*rows),
        q.column_count(6),
        q.column_order(SUBSCRIBERS_RAW.fieldNames()),
        q.unique("mailchimp_id"),
        q.not_null("mailchimp_id"),
        q.not_null("user_email"),
        q.matches("user_email", q.EMAIL_PATTERN),
        q.not_null("user_full_name"),
        q.matches("country_code", q.COUNTRY_PATTERN),
        q.in_set("country_code", SUBSCRIBER_COUNTRIES),
        q.matches("optin_time", q.DATE_PATTERN),
        q.between("member_rating", 1, 5),
    ]


def tags_suite(rows: tuple[int, int] = TAG_ROWS) -> list[q.Check]:
    return [
        q.row_count(*rows),
        q.column_count(2),
        q.column_order(TAGS_RAW.fieldNames()),
        q.not_null("mailchimp_id"),
        q.not_null("tag"),
        q.matches("tag", q.NOT_EMPTY_PATTERN),
    ]


def transactions_suite(rows: tuple[int, int] = TRANSACTION_ROWS) -> list[q.Check]:
    return [
        q.row_count(*rows),
        q.column_count(6),
        q.column_order(TRANSACTIONS_RAW.fieldNames()),
        q.unique("transaction_id"),
        q.not_null("transaction_id"),
        q.not_null("user_email"),
        q.not_null("product_id"),
        q.matches("user_email", q.EMAIL_PATTERN),
        q.not_null("purchased_at"),
        q.matches("purchased_at", q.DATE_PATTERN),
        q.between("product_id", 1, 100),
        q.in_set("charge_country", CHARGE_COUNTRIES),
    ]


def joined_suite(rows: tuple[int, int] = JOINED_ROWS) -> list[q.Check]:
    return [
        q.row_count(*rows),
        q.column_count(8),
        q.column_order(SUBSCRIBERS_JOINED_COLUMNS),
        q.unique("mailchimp_id"),
        q.not_null("mailchimp_id"),
        q.not_null("user_email"),
        q.matches("user_email", q.EMAIL_PATTERN),
        q.between("member_rating", 1, 5),
        q.type_is("tag_count", "bigint"),
        q.not_null("tag_count"),
        q.min_between("tag_count", 0, 0),
        q.not_null("made_purchase"),
        q.in_set("made_purchase", [0, 1]),
        q.mean_between("made_purchase", *CONVERSION_RANGE),
        q.date_format("optin_time"),
    ]


def business_suite(
    conversion: tuple[float, float] = CONVERSION_RANGE, max_domain_share: float = MAX_DOMAIN_SHARE
) -> list[q.Check]:
    """Rules on the joined table with its ``email_domain`` added."""
    return [
        q.mean_between("made_purchase", *conversion),
        q.matches("country_code", q.COUNTRY_PATTERN),
        q.in_set("made_purchase", [0, 1]),
        q.share_at_most("email_domain", max_domain_share),
    ]


def as_written(joined: DataFrame) -> DataFrame:
    """The joined table with its time as date text, the form the file checks are stated for.

    A time of day is kept in the text, so that it fails the date format.
    """
    time = F.col("optin_time")
    midnight = F.date_trunc("day", time) == time
    text = F.when(midnight, F.date_format(time, "yyyy-MM-dd")).otherwise(time.cast("string"))
    return joined.withColumn("optin_time", text)


def with_domain(joined: DataFrame) -> DataFrame:
    return joined.withColumn("email_domain", F.expr(email_domain()))
