from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from propensa.operators import encode, split
from propensa.plans.prepare import prepare_leads


def labelled(spark, n, positive_every):
    return spark.range(n).select("id", (F.col("id") % positive_every == 0).cast("int").alias("y"))


def sizes(df):
    return {(r["y"], r["fold"]): r["count"] for r in df.groupBy("y", "fold").count().collect()}


def test_published_sizes():
    got = split.fold_sizes({0: 18923, 1: 996})
    assert sum(c["train"] for c in got.values()) == 11951
    assert sum(c["val"] for c in got.values()) == sum(c["test"] for c in got.values()) == 3984
    assert got[1]["train"] in (597, 598) and {got[1]["val"], got[1]["test"]} <= {199, 200}


@pytest.mark.parametrize("limit", [None, 7])
def test_exact_split(spark, limit):
    df = labelled(spark, 1000, 20)
    got = sizes(split.split_exact(df, "y", "id", ranges=limit))
    assert got == {
        (0, "train"): 570, (0, "val"): 190, (0, "test"): 190,
        (1, "train"): 30, (1, "val"): 10, (1, "test"): 10,
    }


def test_split_does_not_depend_on_partitions(spark):
    df = labelled(spark, 500, 7)
    for folded in (lambda d: split.split_exact(d, "y", "id"), lambda d: split.split_fast(d, "id")):
        a = {r["id"]: r["fold"] for r in folded(df.coalesce(1)).collect()}
        b = {r["id"]: r["fold"] for r in folded(df.repartition(13, "y")).collect()}
        assert a == b
    other = {r["id"]: r["fold"] for r in split.split_fast(df, "id", seed=7).collect()}
    assert other != a


def test_fast_split_is_close(spark):
    got = split.split_fast(labelled(spark, 20000, 20), "id").groupBy("fold").count().collect()
    share = {r["fold"]: r["count"] / 20000 for r in got}
    assert abs(share["train"] - 0.6) < 0.02 and abs(share["val"] - 0.2) < 0.02


def test_tiny_and_repeated_keys(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (2, 1)], "id long, y int")
    rows = split.split_exact(df, "y", "id").collect()
    assert len(rows) == 3
    assert len({r["fold"] for r in rows if r["id"] == 2}) == 1


def test_a_row_without_label_is_refused(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "id long, y int")
    with pytest.raises(ValueError, match="1 rows have no y"):
        split.split_exact(df, "y", "id")


def test_fold_rows(spark):
    df = split.split_fast(labelled(spark, 100, 5), "id")
    both = split.fold_rows(df, "train", "val")
    assert both.count() == 100 - split.fold_rows(df, "test").count()


@pytest.mark.parametrize("limit", [None, 7])
def test_codes_follow_text_order(spark, limit):
    df = spark.createDataFrame([("us",), ("10",), ("2",), ("au",), ("other",), (None,), ("us",)], "c string")
    got = {r["value"]: r["code"] for r in encode.fit_codes(df, "c", ranges=limit).collect()}
    assert got == {"10": 0, "2": 1, "au": 2, "nan": 3, "other": 4, "us": 5}


def test_apply_codes(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, c string")
    codes = encode.fit_codes(df, "c")
    coded = encode.apply_codes(df, "c", codes)
    assert coded.columns == ["id", "c"]
    assert {r["id"]: r["c"] for r in coded.collect()} == {1: 1, 2: 0, 3: 2}
    unseen = spark.createDataFrame([(1, "z"), (2, "a")], "id int, c string")
    with pytest.raises(Exception, match="unseen value in c: z"):
        encode.apply_codes(unseen, "c", codes).collect()
    assert {r["id"]: r["c"] for r in encode.apply_codes(unseen, "c", codes, "keep").collect()} == {1: 3, 2: 0}
    with pytest.raises(ValueError, match="unseen must be"):
        encode.apply_codes(unseen, "c", codes, "drop")


def test_encoders_save_and_load(spark, tmp_path):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("a", "x")], "c string, d string")
    encoders = encode.fit_encoders(df, ["c", "d"])
    encoders.save(str(tmp_path / "codes"))
    loaded = encode.Encoders.load(spark, str(tmp_path / "codes"))
    assert loaded.columns == ["c", "d"]
    a, _ = encode.apply_encoders(df, ["c", "d"], encoders)
    b, _ = encode.apply_encoders(df, ["c", "d"], loaded)
    assert a.collect() == b.collect()


def test_apply_without_encoder_is_reported(spark):
    df = spark.createDataFrame([("b", "x")], "c string, d string")
    coded, skipped = encode.apply_encoders(df, ["c", "d"], encode.fit_encoders(df, ["c"]))
    assert skipped == ["d"] and tuple(coded.first()) == (0, "x")
    with pytest.raises(encode.NotFitted):
        encode.apply_encoders(df, ["c"], None)


def test_prepare_fit_then_apply(spark):
    schema = "user_email string, optin_time string, country_code string, tag_count int, tag_x int"
    train = spark.createDataFrame([("a@x.com", "2019-01-01", "us", 1, None), ("b@y.com", "2019-01-03", "zz", 0, 1)], schema)
    fitted = prepare_leads(train)
    assert fitted.encoders.columns == ["country_code", "email_provider"]
    one = spark.createDataFrame([("c@x.com", "2019-01-01", "us", 1, 1)], schema)
    with pytest.raises(encode.NotFitted):
        prepare_leads(one, fit=False)
    applied = prepare_leads(one, fitted.encoders, fit=False).leads.first()
    assert (applied["country_code"], applied["email_provider"], applied["user_email"]) == (1, 0, "c@x.com")


def test_ordinal(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "r int")
    code = encode.ordinal("r", ["1", "2", "3", "4", "5"])
    assert [r[0] for r in df.select(code).collect()] == [0, 4, None]
    with pytest.raises(Exception, match="outside its order"):
        spark.createDataFrame([(9,)], "r int").select(code).collect()
