"""Push rows published with a two-phase commit: a Python data source whose tasks stage parts and whose driver publishes them once.

``<path>/staged/<run>/`` receives one Arrow file for each task attempt; ``<path>/dt=<date>/current`` names the
run and the parts in force. Tasks write to names of their own, so a failed, retried or speculated task leaves a part that
no commit names. The driver publishes by writing ``current`` under a new name and moving it over the old one; a run of a
date that is done again replaces its rows, and a job that fails at any point leaves the date as it was. What no date names is
deleted by the next commit of its date, or by ``abort``.

The same folder reads back as a DataFrame of the dates' rows, one partition a part. The path must be one that driver and executors
share: local paths in tests, else any that Arrow's file systems know (hdfs, s3, gs).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from .adapters import dt_key

FORMAT = "tagloom_published"
SCHEMA = "ID string, MEMBER_ID string, PROD_ID string, STATUS int"


@dataclass
class Part(WriterCommitMessage):
    name: str
    rows: int


@dataclass
class Stored(InputPartition):
    dt: str
    file: str


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _read_json(fs: pafs.FileSystem, file: str):
    if fs.get_file_info(file).type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(file) as f:
        return json.loads(f.read())


class PublishedRows(DataSource):
    """Options: path; for writing also run_dt, for reading also dt (all dates if not given)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA + ", dt string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return StagedWriter(self.options["path"], dt_key(self.options["run_dt"]))

    def reader(self, schema: StructType) -> DataSourceReader:
        return PublishedReader(self.options["path"], self.options.get("dt"))


class StagedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, dt: str):
        self.path, self.dt, self.run = path, dt, uuid.uuid4().hex

    def _staged(self) -> str:
        return f"staged/{self.run}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        fs, root = _open(self.path)
        task, rows = TaskContext.get(), 0
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.arrow"
        fs.create_dir(f"{root}/{self._staged()}", recursive=True)
        writer = None
        with fs.open_output_stream(f"{root}/{self._staged()}/{name}") as out:
            for batch in iterator:
                writer = writer or pa.ipc.new_stream(out, batch.schema)
                writer.write_batch(batch)
                rows += batch.num_rows
            if writer:
                writer.close()
        return Part(name, rows)

    def commit(self, messages: list[Part | None]) -> None:
        fs, root = _open(self.path)
        folder, before = f"{root}/dt={self.dt}", _read_json(fs, f"{root}/dt={self.dt}/current")
        fs.create_dir(folder, recursive=True)
        parts = sorted(m.name for m in messages if m and m.rows)
        with fs.open_output_stream(f"{folder}/next-{self.run}") as out:
            out.write(json.dumps({"run": self.run, "parts": parts, "rows": sum(m.rows for m in messages if m)}).encode())
        fs.move(f"{folder}/next-{self.run}", f"{folder}/current")
        if before and before["run"] != self.run:
            self._drop(fs, f"{root}/staged/{before['run']}")
        staged = f"{root}/{self._staged()}"  # what retried tasks left
        for info in fs.get_file_info(pafs.FileSelector(staged, allow_not_found=True)):
            if info.base_name not in parts:
                fs.delete_file(info.path)

    def abort(self, messages: list[Part | None]) -> None:
        fs, root = _open(self.path)
        self._drop(fs, f"{root}/{self._staged()}")

    @staticmethod
    def _drop(fs: pafs.FileSystem, folder: str) -> None:
        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)


class PublishedReader(DataSourceReader):
    def __init__(self, path: str, dt: str | None):
        self.path, self.dt = path, dt and dt_key(dt)

    def partitions(self) -> list[Stored]:
        fs, root = _open(self.path)
        out = []
        for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            dt = info.base_name.removeprefix("dt=")
            if info.base_name.startswith("dt=") and self.dt in (None, dt):
                current = _read_json(fs, f"{info.path}/current")
                out += [Stored(dt, f"staged/{current['run']}/{p}") for p in (current or {"parts": []})["parts"]]
        return out or [Stored("", "")]

    def read(self, partition: Stored) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        fs, root = _open(self.path)
        with fs.open_input_stream(f"{root}/{partition.file}") as f, pa.ipc.open_stream(f) as stream:
            for batch in stream:
                yield batch.append_column("dt", pa.array([partition.dt] * batch.num_rows))


def publish(rows: DataFrame, path: str, run_dt: str) -> None:
    """Replace the rows of a date: all parts are staged, then put in force at once."""
    rows.sparkSession.dataSource.register(PublishedRows)
    rows.select("ID", "MEMBER_ID", "PROD_ID", "STATUS").write.format(FORMAT).mode("append").option("path", path).option("run_dt", run_dt).save()


def published(spark: SparkSession, path: str, dt: str | None = None) -> DataFrame:
    """The rows in force of a date, or of all, with their ``dt``."""
    spark.dataSource.register(PublishedRows)
    reader = spark.read.format(FORMAT).option("path", path)
    return (reader.option("dt", dt) if dt else reader).load()
