"""A stream of records in batches of a stated number, whatever the size of the files they lie in.

Spark's file source bounds a micro-batch in files or bytes. This source counts records: an offset is a file name
and a number of rows in it, and every batch takes the next ``batch`` records at most, over as many files as that needs.
Row counts come from the files' footers; rows are read by the tasks, a slice of a file each. Files are taken in the
order of their names, so a new file must be named after those that are there.

The engine takes a part of a second for each of its own batches. A stream may therefore take many batches of records
with one of them: the source numbers its batches itself, hands them on one by one, and each row names its own.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

# Fixed value: the published size of a batch of requests.
BATCH = 32
# Batches that the engine takes at a time where rows name their own: some tens of files' worth of work for its tasks.
TOGETHER = 4096
NUMBER = "batch"


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it; a plain path is local (or mounted)."""
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/", 1)[0] else (pafs.LocalFileSystem(), path)


@dataclass
class Slice(InputPartition):
    """Rows of one file. ``number`` and ``ahead``: the batch that they continue and how many rows it has already."""

    file: str
    first: int
    count: int
    number: int = 0
    ahead: int = 0


class RecordReader(DataSourceStreamReader):
    """Offsets are {"file": name of the last file read from, "row": rows read of it, "batch": number of the next batch}."""

    def __init__(self, schema: StructType, path: str, batch: int, together: int | None = None):
        self.schema, self.path, self.batch, self.together = schema, path, batch, together
        self.at: dict | None = None
        self.counts: dict[str, int] = {}

    def _files(self) -> tuple[pafs.FileSystem, list[str]]:
        system, root = _place(self.path)
        found = system.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        return system, sorted(f.path for f in found if f.is_file and f.base_name.endswith(".parquet") and f.base_name[0] not in "._")

    def _slices(self, start: dict) -> Iterator[Slice]:
        """What follows an offset, file by file."""
        system, files = self._files()
        for file in files:
            name = file.rsplit("/", 1)[-1]
            if name < start["file"]:
                continue
            if file not in self.counts:
                with system.open_input_file(file) as handle:
                    self.counts[file] = pq.ParquetFile(handle).metadata.num_rows
            first = start["row"] if name == start["file"] else 0
            if self.counts[file] > first:
                yield Slice(file, first, self.counts[file] - first)

    def initialOffset(self) -> dict:
        return {"file": "", "row": 0, "batch": 0}

    def latestOffset(self) -> dict:
        """The end of the next batch, or of as many as are taken together: the engine asks once for each."""
        self.at = self.at or self.initialOffset()
        most = self.batch * (self.together or 1)
        end, left = self.at, most
        for part in self._slices(self.at):
            taken = min(left, part.count)
            end = {"file": part.file.rsplit("/", 1)[-1], "row": part.first + taken}
            left -= taken
            if not left:
                break
        if left < most:
            # Only the last batch of what is there now may hold fewer records.
            self.at = {**end, "batch": self.at.get("batch", 0) - (left - most) // self.batch}
        return self.at

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        # After a restart the engine asks for its last batch again, before it asks for a new one.
        self.at = self.at or end
        found, before = [], 0
        for part in self._slices(start):
            name = part.file.rsplit("/", 1)[-1]
            if name > end["file"]:
                break
            count = end["row"] - part.first if name == end["file"] else part.count
            if count > 0:
                found.append(Slice(part.file, part.first, count, start.get("batch", 0) + before // self.batch, before % self.batch))
                before += count
        return found

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        system, _ = _place(self.path)
        skipped, left = 0, partition.count
        names = [f.name for f in self.schema.fields][:-1 if self.together else None]
        number, room = partition.number, self.batch - partition.ahead
        with system.open_input_file(partition.file) as handle:
            file = pq.ParquetFile(handle)
            for group in range(file.num_row_groups):
                rows = file.metadata.row_group(group).num_rows
                if left and skipped + rows > partition.first:
                    table = file.read_row_group(group, columns=names).select(names)
                    table = table.slice(max(0, partition.first - skipped), left)
                    left -= len(table)
                    if not self.together:
                        yield from table.combine_chunks().to_batches()
                    at = 0
                    while self.together and at < len(table):
                        taken = table.slice(at, room)
                        yield from taken.append_column(NUMBER, pa.array([number] * len(taken), pa.int64())).combine_chunks().to_batches()
                        at, room = at + len(taken), room - len(taken)
                        if not room:
                            number, room = number + 1, self.batch
                skipped += rows


class LeadRecords(DataSource):
    """Format ``lead_records``: options ``path`` (a folder of Parquet files), ``batch`` and ``together``; the schema must be given."""

    @classmethod
    def name(cls) -> str:
        return "lead_records"

    def streamReader(self, schema: StructType) -> RecordReader:
        together = self.options.get("together")
        return RecordReader(schema, self.options["path"], int(self.options.get("batch", BATCH)), int(together) if together else None)


def record_stream(spark: SparkSession, path: str, schema: StructType, batch: int = BATCH, together: int | None = None) -> DataFrame:
    """Records of a folder as a stream, at most ``batch`` of them in a micro-batch.

    With ``together``, the engine takes so many batches at a time, and the rows have the number of their own as ``batch``.
    """
    if batch < 1:
        raise ValueError(f"a batch holds at least one record, not {batch}")
    if together is not None:
        if together < 1:
            raise ValueError(f"at least one batch is taken at a time, not {together}")
        schema = StructType([*schema.fields]).add(NUMBER, "long")
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package
    spark.dataSource.register(LeadRecords)
    reader = spark.readStream.format("lead_records").schema(schema).option("batch", batch)
    return (reader.option("together", together) if together else reader).load(path)


def start_batches(rows: DataFrame, out_path: str, checkpoint_path: str) -> StreamingQuery:
    """Write every micro-batch to a folder named by its id; one that runs again overwrites its own."""
    folder = "together" if NUMBER in rows.columns else NUMBER

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/{folder}={batch_id}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path).start()


def run_batches(rows: DataFrame, out_path: str, checkpoint_path: str) -> None:
    """Process what is there now, batch by batch, and stop."""
    query = start_batches(rows, out_path, checkpoint_path)
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def batches(spark: SparkSession, out_path: str, schema: StructType) -> DataFrame:
    """Written batches: every record with the id and the size of its batch."""
    rows = spark.read.schema(StructType([*schema.fields]).add("batch", "long")).option("basePath", out_path).parquet(out_path)
    sizes = rows.groupBy("batch").agg(F.count("*").alias("batch_size"))
    return rows.select(*schema.names, "batch").join(sizes, "batch")
