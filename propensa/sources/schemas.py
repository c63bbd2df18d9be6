"""Column names and types of the tables the toolkit reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

SUBSCRIBERS_RAW = T.StructType([
    T.StructField("mailchimp_id", T.LongType()),
    T.StructField("user_full_name", T.StringType()),
    T.StructField("user_email", T.StringType()),
    T.StructField("member_rating", T.IntegerType()),
    T.StructField("optin_time", T.StringType()),
    T.StructField("country_code", T.StringType()),
])

TAGS_RAW = T.StructType([
    T.StructField("mailchimp_id", T.LongType()),
    T.StructField("tag", T.StringType()),
])

TRANSACTIONS_RAW = T.StructType([
    T.StructField("transaction_id", T.LongType()),
    T.StructField("purchased_at", T.StringType()),
    T.StructField("user_full_name", T.StringType()),
    T.StructField("user_email", T.StringType()),
    T.StructField("charge_country", T.StringType()),
    T.StructField("product_id", T.IntegerType()),
])

# Types the ingest step casts to; columns not named keep their scanned type.
SUBSCRIBERS_CASTS = {"mailchimp_id": "bigint", "member_rating": "int", "optin_time": "timestamp"}
TAGS_CASTS = {"mailchimp_id": "bigint"}
TRANSACTIONS_CASTS = {"purchased_at": "timestamp", "product_id": "int"}

SUBSCRIBERS_JOINED_COLUMNS = [
    "mailchimp_id", "user_full_name", "user_email", "member_rating",
    "optin_time", "country_code", "tag_count", "made_purchase",
]

SUBSCRIBERS_JOINED = T.StructType([
    T.StructField("mailchimp_id", T.LongType()),
    T.StructField("user_full_name", T.StringType()),
    T.StructField("user_email", T.StringType()),
    T.StructField("member_rating", T.IntegerType()),
    T.StructField("optin_time", T.TimestampType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("tag_count", T.LongType()),
    T.StructField("made_purchase", T.IntegerType()),
])

def lead_schema(tag_columns: list[str]) -> T.StructType:
    """Typed scoring record: fixed contact fields plus one 0/1 field per tag column."""
    fields = [
        T.StructField("user_email", T.StringType()),
        T.StructField("optin_time", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("member_rating", T.IntegerType()),
        T.StructField("tag_count", T.IntegerType()),
    ]
    return T.StructType(fields + [T.StructField(name, T.IntegerType()) for name in tag_columns])
