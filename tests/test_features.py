from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from propensa.functions.names import clean_name, tag_columns
from propensa.operators import columns
from propensa.operators.summaries import null_profile
from propensa.plans import prepare


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_days_are_floored_elapsed_days(spark):
    df = spark.createDataFrame(
        [(1, "2019-01-06 01:00:00"), (2, "2019-01-07 02:00:00"), (3, "2019-01-07 01:59:59"),
         (4, "2019-01-06 02:00:00")],
        "id int, optin_time string",
    )
    got = {r["id"]: r["optin_days"] for r in prepare.add_dates(df).collect()}
    assert got == {1: -2, 2: 0, 3: -1, 4: -1}


def test_reference_date_parameter(spark):
    df = spark.createDataFrame([("2019-01-06",)], "optin_time string")
    fitted = prepare.add_dates(df, datetime(2019, 1, 10, 12)).first()
    assert fitted["optin_days"] == -5
    assert prepare.add_dates(df).first()["optin_days"] == 0


def test_calendar_parts(spark):
    df = spark.createDataFrame([("2020-12-31",), ("2019-06-01",), (None,)], "optin_time string")
    names = ["optin_month", "optin_day_of_week", "optin_day_of_year", "optin_quarter", "optin_is_weekend"]
    got = rows(prepare.add_dates(df).select(*names))
    assert got == [(12, 3, 366, 4, 0), (6, 5, 152, 2, 1), (None,) * 5]


def test_email_parts(spark):
    df = spark.createDataFrame(
        [(None,), ("nobody",), ("a@b@gmail.com",), ("x@Gmail.com",), ("x@aol.com",), ("x@",)], "user_email string"
    )
    got = rows(prepare.add_email(df).select("email_provider", "is_free_email"))
    assert got == [(None, 0), (None, 0), ("b", 0), ("Gmail.com", 0), ("aol.com", 1), ("", 0)]


def test_country_list(spark):
    df = spark.createDataFrame([("us",), ("US",), ("gb",), (None,)], "country_code string")
    assert rows(prepare.standardize_country(df)) == [("us",), ("other",), ("other",), ("other",)]


def test_activity_rate(spark):
    df = spark.createDataFrame([(6, -2), (0, 0), (3, None)], "tag_count long, optin_days int")
    assert [r[2] for r in prepare.add_activity(df).collect()] == [2.0, 0.0, None]


def test_features_only_for_present_columns(spark):
    df = spark.createDataFrame([("us", None)], "country_code string, tag_a int")
    assert prepare.add_features(df).columns == ["country_code", "tag_a"]
    assert prepare.add_features(df).first()["tag_a"] == 0


@pytest.mark.parametrize("text, name", [
    ("Learning-Lab 05", "learning_lab_05"),
    ("a / b", "a_b"),
    ("it's (new)", "its_new_"),
    ("Café", "cafe"),
    ("x..y", "x_y"),
])
def test_clean_name(text, name):
    assert clean_name(text) == name


def test_tag_columns_collide():
    with pytest.raises(ValueError, match="both become"):
        tag_columns(["a b", "a-b"], [])
    with pytest.raises(ValueError, match="already exists"):
        tag_columns(["count"], ["tag_count"])


def test_fill_missing_keeps_types(spark):
    df = spark.createDataFrame(
        [(None, None, None), (1, float("nan"), "x")], "a int, b double, c string"
    )
    filled = columns.fill_missing(df)
    assert rows(filled) == [(-999, -999.0, None), (1, -999.0, "x")]
    assert filled.dtypes == df.dtypes


def test_align(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert columns.align(df, ["c", "a"], keep=["b"]).columns == ["b", "c", "a"]
    with pytest.raises(columns.MissingColumns) as error:
        columns.align(df, ["c", "z", "y"])
    assert error.value.names == ["y", "z"]


def test_drop_ignores_absent(spark):
    df = spark.createDataFrame([(1, 2)], "mailchimp_id int, x int")
    assert columns.drop_columns(df).columns == ["x"]


def test_column_selectors(spark):
    df = spark.createDataFrame([("a", "b", 1, 2)], "user_email string, name string, tag_a int, tag_count int")
    assert columns.text_columns(df) == ["name"]
    assert columns.tag_names(df) == ["tag_a", "tag_count"]


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(None, float("nan")), (1, 2.0)], "a int, `b c` double")
    assert {r[0]: r[1] for r in null_profile(df).collect()} == {"a": 1, "b c": 1}


def test_matrix_is_numeric_and_complete(spark):
    df = spark.createDataFrame(
        [(1, "n", "a@b.com", 3, "2019-01-01", "us", 1, 0, None), (2, "m", "c@aol.com", None, "2019-02-01", None, 0, 1, 1)],
        "mailchimp_id long, user_full_name string, user_email string, member_rating int, optin_time string, "
        "country_code string, tag_count long, made_purchase int, tag_x int",
    )
    matrix, encoders = prepare.model_matrix(prepare.add_features(df))
    assert all(t != "string" for _, t in matrix.dtypes)
    assert matrix.filter(F.col("member_rating") == -999).count() == 1
    assert matrix.agg(F.max("tag_x"), F.count("tag_x")).first() == (1, 2)
    assert rows(encoders.codes["country_code"].orderBy("code")) == [("other", 0), ("us", 1)]
    assert prepare.feature_names(matrix) == [c for c in matrix.columns if c != "made_purchase"]


def test_reference_date_does_not_depend_on_the_process_time_zone(spark, monkeypatch):
    import time

    from propensa.plans.learning import fit_featurizer

    df = spark.createDataFrame(
        [("a@x.com", "2019-01-01 10:00:00", "us", 1, 0), ("b@x.com", "2019-03-01 09:30:00", "us", 1, 0)],
        "user_email string, optin_time string, country_code string, member_rating int, tag_count int",
    )
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        featurizer = fit_featurizer(df)
        assert featurizer.reference_date == datetime(2019, 3, 1, 9, 30)
        days = [r["f_optin_days"] for r in featurizer.pipeline.transform(df).collect()]
        assert days == [-59.0, 0.0]
        assert [r[0] for r in prepare.add_dates(df, featurizer.reference_date).select("optin_days").collect()] == [-59, 0]
    finally:
        monkeypatch.undo()
        time.tzset()
