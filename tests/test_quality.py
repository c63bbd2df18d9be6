from __future__ import annotations

import pytest

from propensa.operators import quality as q

SCHEMA = "id long, name string, n int, day string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def one(df, check):
    return q.validate(df, "s", [check]).first()


GOOD = [(1, "ab", 1, "2020-02-29"), (2, "cd", 5, "2019-12-31")]

CASES = [
    (q.row_count(1, 3), (3, "ab", 1, "2020-01-01"), None),
    (q.unique("id"), (2, "ab", 1, "2020-01-01"), 2),
    (q.not_null("name"), (3, None, 1, "2020-01-01"), 1),
    (q.matches("name", r"^[a-z]{2}$"), (3, "A1", 1, "2020-01-01"), 1),
    (q.in_set("n", [1, 5, None]), (3, "ab", 2, "2020-01-01"), 1),
    (q.between("n", 1, 5), (3, "ab", 6, "2020-01-01"), 1),
    (q.min_between("n", 1, 1), (3, "ab", 0, "2020-01-01"), None),
    (q.mean_between("n", 1, 3), (3, "ab", 100, "2020-01-01"), None),
    (q.date_format("day"), (3, "ab", 1, "2019-02-29"), 1),
    (q.share_at_most("name", 0.5), (3, "ab", 1, "2020-01-01"), None),
]


@pytest.mark.parametrize("check, bad, unexpected", CASES, ids=lambda c: getattr(c, "kind", None))
def test_passes_and_fails(spark, check, bad, unexpected):
    good = one(frame(spark, *GOOD), check)
    assert good["success"] is True
    rows = [*GOOD, bad] if check.kind != "row_count" else [*GOOD, bad, bad]
    result = one(frame(spark, *rows), check)
    assert result["success"] is False
    if unexpected is not None:
        assert result["unexpected_count"] == unexpected
        assert result["element_count"] == 3


def test_schema_checks(spark):
    df = frame(spark, *GOOD)
    assert one(df, q.column_count(4))["success"] and not one(df, q.column_count(5))["success"]
    assert one(df, q.column_order(["id", "name", "n", "day"]))["success"]
    assert not one(df, q.column_order(["name", "id", "n", "day"]))["success"]
    assert one(df, q.type_is("id", "bigint"))["success"] and not one(df, q.type_is("n", "bigint"))["success"]


@pytest.mark.parametrize("check", [c for c, _, _ in CASES if c.kind not in ("row_count", "not_null")],
                         ids=lambda c: c.kind)
def test_nulls_are_ignored(spark, check):
    df = frame(spark, *GOOD, (None, None, None, None), (None, None, None, None))
    result = one(df, check)
    assert result["success"] is True
    assert result["missing_count"] == 2


def test_null_column_and_empty_table(spark):
    empty = frame(spark)
    nulls = frame(spark, (1, None, None, None))
    for df in (empty, nulls):
        assert one(df, q.matches("name", "x"))["success"] is True
        assert one(df, q.unique("name"))["success"] is True
        assert one(df, q.min_between("n", 0, 0))["success"] is False
        assert one(df, q.mean_between("n", 0, 1))["success"] is False


def test_percent_of_known_values(spark):
    df = frame(spark, (1, "ab", 9, None), (2, "ab", 1, None), (3, "ab", None, None))
    assert one(df, q.between("n", 1, 5))["unexpected_percent"] == 50.0


def test_details(spark):
    df = frame(spark, (1, "zz", 9, "x"), (2, "zz", 1, "x"), (3, "yy", 1, "2020-01-01"), (4, "it's", 1, None))
    checks = [q.in_set("name", ["it's"]), q.date_format("day"), q.between("n", 1, 5), q.not_null("id")]
    summary = {r["check"]: r["partial_unexpected"] for r in q.validate(df, "s", checks, q.SUMMARY).collect()}
    assert summary["in_set(name)"] == ["zz", "yy"]
    assert summary["between(n)"] == ["9"]
    assert summary["not_null(id)"] is None
    failing = {r["id"]: r["failed_checks"] for r in q.failing_rows(df, checks).collect()}
    assert failing == {
        1: ["in_set(name)", "date_format(day)", "between(n)"],
        2: ["in_set(name)", "date_format(day)"],
        3: ["in_set(name)"],
    }
    values = [tuple(r) for r in q.unexpected_values(df, checks, sample=1).collect()]
    assert ("in_set(name)", "zz", 2, 1) in values and len(values) == 3


def test_repeated_rows(spark):
    df = frame(spark, (1, "a", 1, None), (1, "a", 2, None), (1, "b", 2, None), (None, "a", 1, None), (None, "a", 1, None))
    assert [tuple(r) for r in q.repeated_rows(df, ["id", "name"]).collect()] == [(1, "a", 2)]


def test_verdicts_and_gate(spark, tmp_path):
    df = frame(spark, *GOOD)
    good = q.validate(df, "good", [q.unique("id"), q.column_count(4)])
    bad = q.validate(df, "bad", [q.between("n", 2, 3), q.column_count(4)])
    both = good.unionByName(bad)
    verdicts = {r["suite"]: (r["success"], r["failed"], r["success_percent"]) for r in q.verdicts(both).collect()}
    assert verdicts == {"good": (True, 0, 100.0), "bad": (False, 1, 50.0), "overall": (False, 1, 75.0)}
    q.gate(good)
    with pytest.raises(q.QualityError) as error:
        q.gate(both)
    assert error.value.failures == ["bad: between(n)"]
    q.write_results(both, str(tmp_path / "results"))
    assert spark.read.json(str(tmp_path / "results")).count() == 4


@pytest.mark.parametrize("detail", [q.SUMMARY, q.COMPLETE])
def test_details_of_suites_without_value_checks(spark, detail):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "id int, v string")
    rows = {r["check"]: r for r in q.validate(df, "s", [q.unique("id"), q.not_null("v")], detail).collect()}
    assert rows["unique(id)"]["partial_unexpected"] == ["1"] and not rows["unique(id)"]["success"]
    assert rows["not_null(v)"]["partial_unexpected"] is None and rows["not_null(v)"]["unexpected_count"] == 1
    bare = q.validate(df, "s", [q.not_null("v"), q.row_count(1, 9)], detail).collect()
    assert [r["partial_unexpected"] for r in bare] == [None, None]


def test_failing_rows_show_repeated_values(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "7"), (None, "c"), (None, "c")], "id int, v string")
    checks = [q.unique("id"), q.matches("v", "^[a-z]$")]
    got = sorted((r["id"], r["v"], r["failed_checks"]) for r in q.failing_rows(df, checks).collect())
    assert got == [(1, "a", ["unique(id)"]), (1, "b", ["unique(id)"]), (2, "7", ["matches(v)"])]
    assert q.failing_rows(df, [q.row_count(0, 9)]).count() == 0
