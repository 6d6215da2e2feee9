"""A store that shows either all rows of a run or none: tasks stage their rows, the driver publishes them.

The writer is a data source of Spark's own interface. Each attempt of a task stages under a name of its own, and only
the attempts that Spark commits are published, so that failed, repeated and speculative tasks leave no double
rows. A run has a name: publishing it again replaces what it had published, so a job that is started once more after
a crash does no harm.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "netwatch_store"


class Store(Protocol):
    """What a store has to offer. Rows that are staged are not seen by readers."""

    def stage(self, run: str, name: str, batch: pa.RecordBatch) -> str:
        """Holds rows and returns what they are found by."""

    def publish(self, run: str, staged: list[str]) -> None:
        """Shows all of these in one step, in place of what the run had shown before. Must be repeatable."""

    def discard(self, run: str) -> None:
        """Removes what the run has staged and not published."""


class FileStore:
    """Parquet files below a shared folder; a run is published by one file that names its files.

    ``_runs/<run>.json`` is written aside and moved, so a reader finds the old list or the new one.
    """

    def __init__(self, root: str) -> None:
        self.files, self.root = pafs.FileSystem.from_uri(root)

    def stage(self, run: str, name: str, batch: pa.RecordBatch) -> str:
        folder = f"{self.root}/data/{run}"
        self.files.create_dir(folder, recursive=True)
        path = f"{folder}/{name}.parquet"
        pq.write_table(pa.Table.from_batches([batch]), path, filesystem=self.files)
        return f"{run}/{name}.parquet"

    def publish(self, run: str, staged: list[str]) -> None:
        folder = f"{self.root}/_runs"
        self.files.create_dir(folder, recursive=True)
        aside = f"{folder}/.{run}-{uuid.uuid4().hex}"
        with self.files.open_output_stream(aside) as out:
            out.write(json.dumps(sorted(staged)).encode())
        self.files.move(aside, f"{folder}/{run}.json")
        self._remove_others(run, set(staged))

    def discard(self, run: str) -> None:
        self._remove_others(run, set(self._listed(f"{self.root}/_runs/{run}.json")))

    def paths(self) -> list[str]:
        """The files of all published runs."""
        runs = self.files.get_file_info(pafs.FileSelector(f"{self.root}/_runs", allow_not_found=True))
        names = sorted(run.path for run in runs if run.base_name.endswith(".json"))
        return [f"{self.root}/data/{name}" for path in names for name in self._listed(path)]

    def _listed(self, path: str) -> list[str]:
        if self.files.get_file_info(path).type == pafs.FileType.NotFound:
            return []
        with self.files.open_input_stream(path) as held:
            return json.loads(held.readall())

    def _remove_others(self, run: str, kept: set[str]) -> None:
        found = self.files.get_file_info(pafs.FileSelector(f"{self.root}/data/{run}", allow_not_found=True))
        for file in found:
            if f"{run}/{file.base_name}" not in kept:
                self.files.delete_file(file.path)


@dataclass
class Staged(WriterCommitMessage):
    """What one attempt of a task has staged."""

    names: list[str]


class CommitWriter(DataSourceArrowWriter):
    def __init__(self, store: Callable[[], Store], run: str) -> None:
        self.store, self.run = store, run

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        context = TaskContext.get()
        # Attempts of a run that is started again have the same numbers as those before.
        attempt = f"{context.partitionId():05d}-{context.taskAttemptId()}-{uuid.uuid4().hex}"
        store = self.store()
        batches = (batch for batch in iterator if batch.num_rows)
        return Staged([store.stage(self.run, f"{attempt}-{i}", batch) for i, batch in enumerate(batches)])

    def commit(self, messages: list[Staged | None]) -> None:
        self.store().publish(self.run, [name for message in messages if message for name in message.names])

    def abort(self, messages: list[Staged | None]) -> None:
        self.store().discard(self.run)


def write_committed(df: DataFrame, store: Callable[[], Store], run: str | None = None) -> str:
    """Writes a frame to a store as one run and returns the run's name.

    A failure is raised, and nothing of the run is shown then. Two runs of one name must not be written at the same time.
    """
    name = run or uuid.uuid4().hex

    class StoreSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return FORMAT

        def writer(self, schema: StructType, overwrite: bool) -> CommitWriter:
            return CommitWriter(store, name)

    df.sparkSession.dataSource.register(StoreSource)
    df.write.format(FORMAT).mode("append").save()
    return name


def read_files(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """All rows published in the file store below ``root``; no rows before the first run."""
    paths = FileStore(root).paths()
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
