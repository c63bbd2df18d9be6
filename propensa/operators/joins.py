"""Subscriber-level joins: tag counts and the purchase flag.

The looked-up side is reduced to one row per key before it is shuffled, and the
joins are null-safe. A null-safe join shuffles that reduced side once more, on
its own expressions; this costs little and lets adaptive execution split a hot
key among the subscribers, which it cannot do over an unshuffled aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def look_up(rows: DataFrame, table: DataFrame, key: str, table_key: str) -> DataFrame:
    """Left join of a table with one row per key; null matches null. Only ``key`` is compared."""
    clash = [c for c in table.columns if c != table_key and c in rows.columns]
    if clash:
        raise ValueError(f"columns already present: {clash}")
    renamed = table.withColumnRenamed(table_key, "__key")
    return rows.join(renamed, rows[key].eqNullSafe(renamed["__key"]), "left").drop("__key")


def tag_counts(tags: DataFrame, key: str = "mailchimp_id") -> DataFrame:
    """Number of non-null tags per subscriber."""
    return tags.groupBy(key).agg(F.count("tag").alias("tag_count"))


def with_tag_count(subscribers: DataFrame, tags: DataFrame, key: str = "mailchimp_id") -> DataFrame:
    """Left join of the counts; subscribers without tags get 0."""
    joined = look_up(subscribers, tag_counts(tags, key), key, key)
    return joined.withColumn("tag_count", F.expr("coalesce(tag_count, 0L)"))


def with_purchase_flag(subscribers: DataFrame, transactions: DataFrame, email: str = "user_email") -> DataFrame:
    """1 when the email has a transaction, else 0. Case-sensitive; null matches null."""
    buyers = transactions.select(email).distinct().withColumn("made_purchase", F.lit(1))
    joined = look_up(subscribers, buyers, email, email)
    return joined.withColumn("made_purchase", F.expr("coalesce(made_purchase, 0)"))
