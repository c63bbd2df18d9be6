from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from propensa.operators import encode, joins, pivot
from propensa.plans.ingest import join_subscribers, typed
from propensa.sources.tables import CrmTables, cast_columns


@pytest.fixture
def subscribers(spark):
    return spark.createDataFrame(
        [(1, "a@x.com"), (2, "A@x.com"), (3, None)], "mailchimp_id long, user_email string"
    )


@pytest.fixture
def tags(spark):
    return spark.createDataFrame([(1, "t"), (1, None), (1, "u v"), (2, None)], "mailchimp_id long, tag string")


def test_tag_count_skips_null_tags(subscribers, tags):
    got = {r[0]: r["tag_count"] for r in joins.with_tag_count(subscribers, tags).collect()}
    assert got == {1: 2, 2: 0, 3: 0}


def test_purchase_flag_is_case_sensitive_and_null_matches_null(spark, subscribers):
    buyers = spark.createDataFrame([("a@x.com",), ("a@x.com",)], "user_email string")
    got = {r[0]: r["made_purchase"] for r in joins.with_purchase_flag(subscribers, buyers).collect()}
    assert got == {1: 1, 2: 0, 3: 0}
    with_null = buyers.union(spark.createDataFrame([(None,)], "user_email string"))
    got = {r[0]: r["made_purchase"] for r in joins.with_purchase_flag(subscribers, with_null).collect()}
    assert got == {1: 1, 2: 0, 3: 1}


def test_joins_refuse_existing_columns(subscribers, tags):
    with pytest.raises(ValueError, match="tag_count"):
        joins.with_tag_count(subscribers.withColumn("tag_count", F.lit(1)), tags)


def test_pivot(tags):
    wide = pivot.tag_pivot(tags)
    assert wide.columns == ["mailchimp_id", "tag_t", "tag_u_v"]
    assert sorted(tuple(r) for r in wide.collect()) == [(1, 1, 1), (2, 0, 0)]


def test_pivot_repeated_pair(tags):
    repeated = tags.union(tags)
    assert sorted(tuple(r) for r in pivot.tag_pivot(repeated, strict=False).collect()) == [(1, 1, 1), (2, 0, 0)]
    with pytest.raises(Exception, match="repeated tag"):
        pivot.tag_pivot(repeated).collect()


def test_pivot_with_fitted_vocabulary(tags):
    assert pivot.tag_pivot(tags, ["t", "unused"]).columns == ["mailchimp_id", "tag_t", "tag_unused"]


def test_vocabulary_is_kept(spark, tags, tmp_path):
    pivot.save_vocabulary(spark, pivot.tag_vocabulary(tags), str(tmp_path / "tags"))
    kept = pivot.load_vocabulary(spark, str(tmp_path / "tags"))
    assert kept == ["t", "u v"]
    later = spark.createDataFrame([(9, "new"), (9, "t")], "mailchimp_id long, tag string")
    assert [tuple(r) for r in pivot.tag_pivot(later, kept).collect()] == [(9, 1, 0)]


def test_vocabulary_limit(spark, tags):
    spark.conf.set(pivot.MAX_TAGS_CONF, "1")
    try:
        with pytest.raises(ValueError, match="more than 1"):
            pivot.tag_vocabulary(tags)
    finally:
        spark.conf.unset(pivot.MAX_TAGS_CONF)


def test_tags_do_not_become_join_keys(spark, subscribers):
    tags = spark.createDataFrame([(1, "count")], "mailchimp_id long, tag string")
    counted = joins.with_tag_count(subscribers, tags)
    with pytest.raises(ValueError, match="already exists"):
        pivot.tag_pivot(tags, taken=counted.columns[1:])
    with pytest.raises(ValueError, match="already present"):
        pivot.with_tags(counted, pivot.tag_pivot(tags))


def test_leads_without_tags_keep_nulls(subscribers, tags):
    got = {r[0]: r["tag_t"] for r in pivot.with_tags(subscribers, pivot.tag_pivot(tags)).collect()}
    assert got == {1: 1, 2: 0, 3: None}


def test_bad_id_raises_unless_lenient(spark):
    df = spark.createDataFrame([("1",), ("x",)], "mailchimp_id string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_columns(df, {"mailchimp_id": "bigint"}).collect()
    assert [r[0] for r in cast_columns(df, {"mailchimp_id": "bigint"}, lenient=True).collect()] == [1, None]


def test_joined_from_text_tables(spark):
    crm = CrmTables(
        spark.createDataFrame(
            [("7", "N", "a@x.com", "3", "2019-01-02", "us")],
            "mailchimp_id string, user_full_name string, user_email string, member_rating string, "
            "optin_time string, country_code string",
        ),
        spark.createDataFrame([("7", "t")], "mailchimp_id string, tag string"),
        spark.createDataFrame(
            [(1, "2019-02-01", "N", "a@x.com", "US", "5")],
            "transaction_id long, purchased_at string, user_full_name string, user_email string, "
            "charge_country string, product_id string",
        ),
    )
    row = join_subscribers(crm).first()
    assert (row["mailchimp_id"], row["member_rating"], row["tag_count"], row["made_purchase"]) == (7, 3, 1, 1)
    assert dict(typed(crm).transactions.dtypes)["product_id"] == "int"


def hot_email(spark, n):
    buyers = spark.range(2 * n).select(F.concat(F.col("id") % n, F.lit("@x.com")).alias("user_email"))
    return "made_purchase", lambda s: joins.with_purchase_flag(s, buyers)


def hot_id(spark, n):
    tags = spark.range(2 * n).select((F.col("id") % n).alias("mailchimp_id"), F.lit("t").alias("tag"))
    return "tag_count", lambda s: joins.with_tag_count(s, tags)


def hot_id_wide(spark, n):
    tags = spark.range(n).select(F.col("id").alias("mailchimp_id"), F.lit("t").alias("tag"))
    return "tag_t", lambda s: pivot.with_tags(s, pivot.tag_pivot(tags))


def hot_code(spark, n):
    codes = spark.range(n).select(F.concat("id", F.lit("@x.com")).alias("value"), F.lit(1).alias("code"))
    return "user_email", lambda s: encode.apply_codes(s, "user_email", codes)


@pytest.mark.parametrize("case", [hot_email, hot_id, hot_id_wide, hot_code])
def test_hot_key_is_split(spark, tmp_path, case):
    """A third of the subscribers share one key: the join splits that key over tasks."""
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    spark.range(n).select(
        key.alias("mailchimp_id"),
        F.concat(key, F.lit("@x.com")).alias("user_email"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    ).repartition(16).write.parquet(str(tmp_path / "subscribers"))
    subscribers = spark.read.parquet(str(tmp_path / "subscribers"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        column, join = case(spark, n)
        joined = join(subscribers)
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(rows) == n
    assert {r[column] for r in rows} == {2 if column == "tag_count" else 1}
    assert "SortMergeJoin(skew=true)" in plan


def test_tag_vectors_are_the_pivot(spark):
    rows = [(i, f"t{(i * 7 + j * 3) % 23:02d}") for i in range(40) for j in range(i % 5)]
    tags = spark.createDataFrame([*rows, (90, None)], "mailchimp_id long, tag string")
    wide = {r[0]: list(r)[1:] for r in pivot.tag_pivot(tags.filter("tag is not null")).collect()}
    vectors = pivot.tag_vectors(tags).collect()
    assert len(vectors) == len(wide)
    for r in vectors:
        dense = [0] * r["size"]
        for place, value in zip(r["indices"], r["values"], strict=True):
            dense[place] = int(value)
        assert dense == wide[r["mailchimp_id"]]


def test_repeated_tags_in_vectors(spark):
    tags = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "mailchimp_id long, tag string")
    with pytest.raises(Exception, match="repeated tag for 1"):
        pivot.tag_vectors(tags).collect()
    assert [list(r["indices"]) for r in pivot.tag_vectors(tags, strict=False).collect()] == [[0, 1]]


def test_a_given_vocabulary_fixes_the_places(spark):
    tags = spark.createDataFrame([(1, "a"), (1, "z"), (2, "b")], "mailchimp_id long, tag string")
    known = pivot.ranked_vocabulary(spark.createDataFrame([("b",), ("a",), ("c",)], "tag string"))
    assert sorted((r["mailchimp_id"], r["size"], r["indices"]) for r in pivot.tag_vectors(tags, known).collect()) == [(1, 3, [0]), (2, 3, [1])]
