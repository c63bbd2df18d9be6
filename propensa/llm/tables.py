"""Reading the given tables, and sending this package to the executors' Python."""

from __future__ import annotations

import ctypes
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parents[1]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, as Spark's own reader sees it (any store, file or folder)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send the package once per application, as ``--py-files`` would; Python workers then import it
    and keep what its modules remember from task to task."""
    name = f"{PACKAGE.name}.zip"
    if name in spark.sparkContext._python_includes:
        return
    place = Path(SparkFiles.getRootDirectory(), "package", name)  # Spark's own folder of files to send
    place.parent.mkdir(exist_ok=True)
    with zipfile.ZipFile(place, "w") as archive:
        for file in sorted(PACKAGE.rglob("*.py")):
            archive.write(file, file.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(place))


def releasing(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work``, after which the Python worker gives freed memory back to the system.

    Workers stay alive between tasks, and what the allocators keep of one stage would count against the next.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run
