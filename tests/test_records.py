from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from propensa.plans import scoring
from propensa.streaming import records


def write_files(spark, path, sizes, start=0):
    for i, size in enumerate(sizes):
        spark.range(start, start + size).selectExpr("id", "concat('u', id) as name").coalesce(1).write.parquet(f"{path}/tmp{start}")
        part = next(p for p in (path / f"tmp{start}").iterdir() if p.suffix == ".parquet")
        part.rename(path / f"{start:08d}.parquet")
        start += size


SCHEMA = "id long, name string"


def test_batches_hold_at_most_the_stated_number(spark, tmp_path):
    write_files(spark, tmp_path / "in", [50, 1, 3, 200, 10])
    schema = spark.createDataFrame([], SCHEMA).schema
    records.run_batches(records.record_stream(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "marks"))
    rows = records.batches(spark, str(tmp_path / "out"), schema).orderBy("id").collect()
    assert [(r["id"], r["name"], r["batch"]) for r in rows] == [(i, f"u{i}", i // 32) for i in range(264)]
    assert max(r["batch_size"] for r in rows) == 32


def test_nothing_is_lost_or_repeated_after_a_restart(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    source, out, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")
    write_files(spark, source, [40])
    records.run_batches(records.record_stream(spark, str(source), schema, batch=7), out, marks)
    write_files(spark, source, [25, 9], start=40)
    stream = records.record_stream(spark, str(source), schema, batch=7)
    failed = []

    def stop_once(batch, batch_id):
        if batch_id == 8:
            failed.append(batch_id)
            raise RuntimeError("lost")
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = stream.writeStream.foreachBatch(stop_once).option("checkpointLocation", marks).start()
    with pytest.raises(Exception, match="lost"):
        query.processAllAvailable()
    query.stop()
    assert failed == [8]
    records.run_batches(records.record_stream(spark, str(source), schema, batch=7), out, marks)
    rows = records.batches(spark, out, schema).orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(74)) and max(r["batch_size"] for r in rows) <= 7


def test_a_batch_holds_a_record(spark, tmp_path):
    with pytest.raises(ValueError, match="at least one"):
        records.record_stream(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema, batch=0)


def scanned(df):
    """Rows that the scan of a plan gave to the filter above it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    nodes = [leaves.apply(i) for i in range(leaves.size())]
    return sum(n.metrics().apply("numOutputRows").value() for n in nodes)


@pytest.mark.parametrize("column, value", [("mailchimp_id", 70_123), ("user_email", "u70123@x.org")])
def test_a_lookup_reads_few_row_groups(spark, tmp_path, column, value):
    path = str(tmp_path / "leads")
    leads = spark.range(100_000).select(F.col("id").alias("mailchimp_id"), F.concat(F.lit("u"), "id", F.lit("@x.org")).alias("user_email"))
    scoring.write_lookup(leads, path, group_rows=2_000)
    found = scoring.lookup(spark, path, column, value)
    assert [r["mailchimp_id"] for r in found.collect()] == [70_123]
    assert scanned(scoring.lookup(spark, path, column, value)) <= 3 * 2_000  # of 50 groups
    assert scanned(spark.read.parquet(path)) == 100_000


def test_many_batches_are_taken_together(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    source, out, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")
    write_files(spark, source, [50, 1, 3, 200, 10])
    records.run_batches(records.record_stream(spark, str(source), schema, batch=7, together=20), out, marks)
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.name[0] != ".") == ["together=0", "together=1"]  # the engine's: 140 and 124 records
    write_files(spark, source, [9], start=264)
    records.run_batches(records.record_stream(spark, str(source), schema, batch=7, together=20), out, marks)
    rows = records.batches(spark, out, schema).orderBy("id").collect()
    # 264 = 37 * 7 + 5: what came later starts a new batch.
    assert [(r["id"], r["name"], r["batch"]) for r in rows] == [(i, f"u{i}", i // 7 if i < 264 else 38 + (i - 264) // 7) for i in range(273)]
    assert [r["batch_size"] for r in rows if r["id"] in (0, 263, 264, 272)] == [7, 5, 7, 2]
