"""Lead features, encoders, matrices and folds."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.functions import features
from propensa.operators import columns, encode, pivot, split
from propensa.operators.summaries import null_profile
from propensa.plans import prepare
from propensa.plans.learning import RATINGS
from propensa.queries.crm import joined_table
from propensa.queries.twins import (
    COUNTRY_COLUMN, DATE_COLUMNS, EMAIL_COLUMNS, TAG_COLUMNS, with_tables,
)
from propensa.session import scratch_path, stored
from propensa.sources import standins
from propensa.sources.tables import write_table

KEY, TARGET = prepare.KEY, prepare.TARGET
DATES = list(features.date_features())


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.merge_tags(joined_table(spark, sf_dir), standins.tags(spark, sf_dir))


@cache
def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leads with their tags as the merge step hands them over: written once."""
    return stored(raw(spark, sf_dir))


def engineered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engineered leads; fitting the encoders on them scans the text columns only."""
    return prepare.add_features(raw_table(spark, sf_dir))


def leads_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_leads(raw_table(spark, sf_dir)).leads


def filled_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.model_matrix(engineered(spark, sf_dir))[0]


def align_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = prepare.add_features(raw_table(spark, sf_dir))
    tag_columns = [c for c in columns.tag_names(leads) if c not in ("tag_count", "tag_count_by_optin_day")]
    order = ["member_rating", "tag_count", *tag_columns, *DATES, "is_free_email", "tag_count_by_optin_day"]
    return columns.align(leads, order, keep=["user_email"])


def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = prepare.standardize_country(standins.subscribers(spark, sf_dir))
    return encode.fit_codes(leads, "country_code")


def split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_exact(joined_table(spark, sf_dir), TARGET, KEY).select(KEY, TARGET, "fold")


def split_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_fast(joined_table(spark, sf_dir), KEY).select(KEY, TARGET, "fold")


def fold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and positives per fold of the exact split."""
    return split_exact(spark, sf_dir).groupBy("fold").agg(
        F.count("*").alias("n_rows"), F.sum(TARGET).alias("n_positive")
    )


def kept_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept test rows: folds written as partitions, of which only one is read back."""
    path = scratch_path(spark, "folds")
    write_table(split_exact(spark, sf_dir), path, partition_by=["fold"])
    return split.fold_rows(spark.read.parquet(path), split.TEST)


def tag_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot.tag_vectors(standins.tags(spark, sf_dir))


def order_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tag per order beside the event tags: more tags than a pivot has columns."""
    orders = standins.source(spark, sf_dir, "orders").selectExpr("o_custkey as mailchimp_id", "concat('order-', o_orderkey) as tag")
    return pivot.tag_vectors(standins.tags(spark, sf_dir).unionByName(orders))


QUERIES = {
    "tag_vectors": tag_vectors,
    "order_vectors": order_vectors,
    "tag_pivot": lambda s, d: pivot.tag_pivot(standins.tags(s, d)),
    "leads_raw": raw,
    "date_features": lambda s, d: prepare.add_dates(joined_table(s, d)).select(KEY, *DATES),
    "email_features": lambda s, d: prepare.add_email(joined_table(s, d)).select(
        KEY, "user_email", "email_provider", "is_free_email"
    ),
    "activity_features": lambda s, d: prepare.add_activity(prepare.add_dates(joined_table(s, d))).select(
        KEY, "tag_count", "optin_days", "tag_count_by_optin_day"
    ),
    "country_standardized": lambda s, d: prepare.standardize_country(joined_table(s, d)).select(KEY, "country_code"),
    "null_profile": lambda s, d: null_profile(raw_table(s, d)),
    "model_columns": lambda s, d: columns.drop_columns(prepare.add_features(raw_table(s, d))),
    "align_features": align_features,
    "country_codes": country_codes,
    "rating_ordinal": lambda s, d: standins.subscribers(s, d).select(
        KEY, "member_rating", encode.ordinal("member_rating", RATINGS).alias("rating_code")
    ),
    "leads_cleaned": leads_cleaned,
    "filled_matrix": filled_matrix,
    "split_folds": split_fast,
    "split_folds_exact": split_exact,
    "fold_counts": fold_counts,
    "test_fold": kept_fold,
    "train_plus_val": lambda s, d: split.fold_rows(split_fast(s, d), split.TRAIN, split.VALIDATION),
}

_UNIT = f"('0x' || substr(md5('{split.SEED}:' || {KEY}), 1, 8))::bigint / 4294967296.0::double"
_FOLD = f"case when {_UNIT} < 0.6 then 'train' when {_UNIT} < 0.8 then 'val' else 'test' end"

# Sizes: the held-out part is rounded up, then halved; classes share by largest remainder.
_FOLDED = f""",
    ranked as (
        select {KEY}, {TARGET},
               row_number() over (partition by {TARGET} order by md5('{split.SEED}:' || {KEY}), {KEY}) as r
        from joined),
    classes as (select {TARGET}, count(*) as n, sum(count(*)) over () as total from joined group by 1),
    held as (select *, cast(ceil(round(0.4 * total, 6)) as bigint) as n_held from classes),
    train_floor as (
        select *, n * (total - n_held) // total as base, n * (total - n_held) % total as rest from held),
    train_size as (
        select *, base + cast(row_number() over (order by rest desc, {TARGET})
                              <= (total - n_held) - sum(base) over () as int) as n_train
        from train_floor),
    val_floor as (
        select *, n - n_train as left_over,
               n_held - cast(ceil(round(0.5 * n_held, 6)) as bigint) as val_rows from train_size),
    val_parts as (
        select *, left_over * val_rows // n_held as val_base, left_over * val_rows % n_held as val_rest from val_floor),
    sizes as (
        select {TARGET}, n_train, val_base + cast(row_number() over (order by val_rest desc, {TARGET})
                                                  <= val_rows - sum(val_base) over () as int) as n_val
        from val_parts),
    folded as (
        select {KEY}, {TARGET},
               case when r <= n_train then 'train' when r <= n_train + n_val then 'val' else 'test' end as fold
        from ranked join sizes using ({TARGET}))
"""


def exact_folds(*tables: str) -> str:
    """``WITH`` clause that defines ``folded``, the exact split, beside the named tables."""
    return with_tables("joined", *tables) + _FOLDED


_VECTORS = """
        vocabulary as (select tag, row_number() over (order by tag) - 1 as place, count(*) over () as size from (select distinct tag from pairs))
        select mailchimp_id, any_value(size) as size, list(place order by place) as indices, list(1.0::double) as values
        from pairs join vocabulary using (tag) group by mailchimp_id"""

SQL = {
    "tag_vectors": with_tables("tags") + ", pairs as (select * from tags)," + _VECTORS,
    "order_vectors": with_tables("tags") + """,
        pairs as (select * from tags union all select o_custkey, 'order-' || o_orderkey from orders),""" + _VECTORS,
    "tag_pivot": with_tables("wide_tags") + "select * from wide_tags",
    "leads_raw": with_tables("leads_raw") + "select * from leads_raw",
    "date_features": with_tables("joined") + f"select {KEY}, {DATE_COLUMNS} from joined",
    "email_features": with_tables("joined") + f"select {KEY}, user_email, {EMAIL_COLUMNS} from joined",
    "activity_features": with_tables("dated") + f"""
        select {KEY}, tag_count, optin_days, tag_count / (abs(optin_days) + 1) as tag_count_by_optin_day
        from dated""",
    "country_standardized": with_tables("joined") + f"select {KEY}, {COUNTRY_COLUMN} from joined",
    "null_profile": with_tables("leads_raw") + " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as null_count from leads_raw"
        for c in [
            "mailchimp_id", "user_full_name", "user_email", "member_rating", "optin_time", "country_code",
            "tag_count", "made_purchase", *TAG_COLUMNS,
        ]
    ),
    "model_columns": with_tables("engineered")
    + "select * exclude (mailchimp_id, user_full_name, user_email, optin_time, email_provider) from engineered",
    "align_features": with_tables("engineered") + f"""
        select user_email, member_rating, tag_count, {', '.join(TAG_COLUMNS)}, {', '.join(DATES)},
               is_free_email, tag_count_by_optin_day
        from engineered""",
    "country_codes": with_tables("subscribers") + f"""
        select value, cast(row_number() over (order by value) - 1 as int) as code
        from (select distinct country_code as value from (select {COUNTRY_COLUMN} from subscribers))""",
    "rating_ordinal": with_tables("subscribers")
    + f"select {KEY}, member_rating, cast(member_rating - 1 as int) as rating_code from subscribers",
    "leads_cleaned": with_tables("engineered") + """
        select * replace (
            cast(dense_rank() over (order by user_full_name) - 1 as int) as user_full_name,
            cast(dense_rank() over (order by country_code) - 1 as int) as country_code,
            cast(dense_rank() over (order by email_provider) - 1 as int) as email_provider)
        from engineered""",
    "filled_matrix": with_tables("matrix") + "select * from matrix",
    "split_folds": with_tables("joined") + f"select {KEY}, {TARGET}, {_FOLD} as fold from joined",
    "split_folds_exact": exact_folds() + "select * from folded",
    "fold_counts": exact_folds() + f"""
        select fold, count(*) as n_rows, cast(sum({TARGET}) as bigint) as n_positive from folded group by 1""",
    "test_fold": exact_folds() + "select * from folded where fold = 'test'",
    "train_plus_val": with_tables("joined") + f"""
        select * from (select {KEY}, {TARGET}, {_FOLD} as fold from joined) where fold in ('train', 'val')""",
}
