from __future__ import annotations

import os
import subprocess
import sys

from conftest import ROOT

from propensa.session import CHECKPOINT_DIR, size_settings, stored, work_folder

WITHOUT_SETTING = """
from propensa.session import build_session, ensure_checkpoint_dir, stored, work_folder
spark = build_session("unset", "local[1]", **{"spark.ui.enabled": "false"})
first = work_folder(spark)
ensure_checkpoint_dir(spark)
assert spark.sparkContext.getCheckpointDir().removeprefix("file:").startswith(first.removeprefix("file:"))
assert first.startswith(spark.conf.get("spark.sql.warehouse.dir"))
assert first.removeprefix("file:") in stored(spark.range(3)).inputFiles()[0]
print("folder", first)
"""


def test_folder_comes_from_the_session(spark):
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        assert work_folder(spark) == folder
    path = stored(spark.range(5)).inputFiles()[0]
    assert f"{work_folder(spark).removeprefix('file:')}/{spark.sparkContext.applicationId}/" in path


def test_warehouse_folder_when_unset(tmp_path):
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT}
    run = subprocess.run(
        [sys.executable, "-c", WITHOUT_SETTING], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "folder " in run.stdout, run.stderr[-2000:]


def test_stored_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 1.5)], "id long, `a b` string, v double")
    assert stored(df).schema.names == df.schema.names
    assert sorted(map(str, stored(df).collect())) == sorted(map(str, df.collect()))
    assert stored(df.limit(0)).count() == 0
    assert stored(df.limit(0), partition_by="id").count() == 0


def test_partitions_grow_with_the_input():
    tb = 1024**4
    assert size_settings(1)["spark.sql.shuffle.partitions"] == "200"
    assert size_settings(tb)["spark.sql.shuffle.partitions"] == "4096"
    assert size_settings(100 * tb)["spark.sql.shuffle.partitions"] == "409600"
