"""Keyed tables written by micro-batches, as plain parquet folders that are merged level by level.

    batches/batch=<id>             what a micro-batch wrote, replaced as a whole when the batch runs again
    runs/run=<generation>          several batches or runs, folded into one
    generations/generation=<n>     the runs that make up the table, and the last batch they hold

The greatest generation that was written to its end is the live one. The table is its runs and all later batches, so
each step of a compaction can be the last one: a run without a generation is not read, and a folder that a
generation replaced is only removed once the generation is there. Folding takes all new batches, and the runs of each
level that has ``fan_in`` of them together with the new one, so a row is written again once per level.

A table has keys and keeps the last write of each (or the last ``versions`` writes), or it has no keys and keeps all
rows. With ``written_at`` its folders are divided by the day of that column, and ``drop_expired`` removes whole days
that are past their time, without reading or writing a row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netwatch.operators.keyed import expire, keep_versions, latest_per_key
from netwatch.sources.files import names_in, remove, written_parts

FAN_IN = 8
DAY = "_written_on"


@dataclass(frozen=True)
class Generation:
    """The live runs as (name, level), and the last batch in them."""

    number: int = 0
    upto: int = -1
    runs: tuple[tuple[int, int], ...] = ()


class KeyedTable:
    """One table below ``path``.

    ``schema`` is what readers get before the first batch. The generations before the live one that still can be read
    are ``kept_generations``: a query that began before a compaction then ends undisturbed.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str] = (),
        versions: int = 1,
        schema: StructType | None = None,
        written_at: str | None = None,
        ttl_seconds: int | None = None,
        fan_in: int = FAN_IN,
        kept_generations: int = 1,
    ) -> None:
        if ttl_seconds is not None and written_at is None:
            raise ValueError("rows expire by the time in written_at")
        self.spark, self.path, self.keys, self.versions, self.schema = spark, path, list(keys), versions, schema
        self.written_at, self.ttl_seconds = written_at, ttl_seconds
        self.fan_in, self.kept_generations = fan_in, kept_generations

    # Writing.

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Writes a batch, in place of what an earlier attempt of it wrote."""
        self._save(batch, f"{self.path}/batches/batch={batch_id}")

    def sink(self, every: int | None = None) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function; every so many batches, the ones before are compacted and old days dropped.

        A batch only begins when those before it are finished, so these can be folded.
        """

        def write(batch: DataFrame, batch_id: int) -> None:
            self.write(batch, batch_id)
            if every and batch_id and batch_id % every == 0:
                self.compact(batch_id - 1)
                if self.ttl_seconds is not None:
                    self.drop_expired()

        return write

    def compact(self, upto: int) -> None:
        """Folds the batches up to ``upto``, which must be finished, and then removes what is no longer needed."""
        live = self.generation()
        fresh = [b for b in self._batches(live.upto) if b <= upto]
        if fresh:
            level, folded, kept = 1, [], list(live.runs)
            while len(same := [run for run in kept if run[1] == level]) + 1 >= self.fan_in:
                folded += same
                kept = [run for run in kept if run[1] != level]
                level += 1
            number = live.number + 1
            rows = self._rows(fresh, [name for name, _ in folded])
            self._save(self._reduced(rows), f"{self.path}/runs/run={number}")
            self._commit(Generation(number, fresh[-1], (*kept, (number, level))))
        self.clean()

    def clean(self) -> None:
        """Removes batches and runs that no generation in use needs. It can be broken off and run again."""
        numbers = sorted(int(n) for n in written_parts(self.spark, f"{self.path}/generations", "generation"))
        if not numbers:
            return
        used = [self._generation(n) for n in numbers if n >= numbers[-1] - self.kept_generations]
        runs = {name for generation in used for name, _ in generation.runs}
        oldest = min(generation.upto for generation in used)
        for batch in self._batches(-1):
            if batch <= oldest:
                remove(self.spark, f"{self.path}/batches/batch={batch}")
        for name in names_in(self.spark, f"{self.path}/runs"):
            if name.startswith("run=") and int(name.removeprefix("run=")) not in runs:
                remove(self.spark, f"{self.path}/runs/{name}")
        for number in numbers:
            if number < used[0].number:
                remove(self.spark, f"{self.path}/generations/generation={number}")

    def drop_expired(self, as_of: dt.datetime | None = None) -> list[str]:
        """Removes the folders of days whose last row has expired, and returns them. No file is opened."""
        now = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        last = now - dt.timedelta(seconds=self.ttl_seconds)
        gone = []
        for kind, column in (("batches", "batch"), ("runs", "run")):
            for part in written_parts(self.spark, f"{self.path}/{kind}", column):
                folder = f"{self.path}/{kind}/{column}={part}"
                for name in names_in(self.spark, folder):
                    day = name.removeprefix(f"{DAY}=")
                    if day == name or day.startswith("__"):  # no day, or rows without a time
                        continue
                    if dt.datetime.fromisoformat(day) + dt.timedelta(days=1) <= last:
                        remove(self.spark, f"{folder}/{name}")
                        gone.append(f"{folder}/{name}")
        return gone

    # Reading.

    def rows(self, as_of: dt.datetime | str | None = None) -> DataFrame:
        """The table: all rows, or the last ones of each key; with ``as_of`` only those alive at that time.

        With several versions a column ``version`` counts them from 1, the newest.
        """
        live = self.generation()
        rows = self._rows(self._batches(live.upto), [name for name, _ in live.runs])
        if rows is None:
            if self.schema is None:
                raise ValueError(f"nothing was written to {self.path} yet, and its schema is not given")
            rows = self.spark.createDataFrame([], self.schema).withColumn("batch", F.lit(0).cast("bigint"))
        if as_of is not None:
            oldest = F.lit(as_of).cast("timestamp") - F.make_dt_interval(secs=F.lit(self.ttl_seconds))
            if DAY in rows.columns:
                rows = rows.filter(F.col(DAY) >= oldest.cast("date"))  # leaves whole folders unread
            rows = expire(rows, self.written_at, self.ttl_seconds, as_of)
        rows = rows.drop(DAY)
        if self.keys and self.versions > 1:
            return keep_versions(rows, self.keys, ["batch"], self.versions).drop("batch")
        return self._reduced(rows).drop("batch")

    def generation(self) -> Generation:
        numbers = [int(n) for n in written_parts(self.spark, f"{self.path}/generations", "generation")]
        return self._generation(max(numbers)) if numbers else Generation()

    # Folders.

    def _save(self, rows: DataFrame, folder: str) -> None:
        writer = rows.drop(DAY)
        if self.written_at:
            day = F.date_format(self.written_at, "yyyy-MM-dd")
            writer = writer.withColumn(DAY, day).write.partitionBy(DAY)
        else:
            writer = writer.write
        writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)

    def _reduced(self, rows: DataFrame) -> DataFrame:
        if not self.keys:
            return rows
        if self.versions == 1:
            return latest_per_key(rows, self.keys, ["batch"])
        return keep_versions(rows, self.keys, ["batch"], self.versions).drop("version")

    def _batches(self, after: int) -> list[int]:
        found = (int(b) for b in written_parts(self.spark, f"{self.path}/batches", "batch"))
        return sorted(b for b in found if b > after)

    def _rows(self, batches: Sequence[int], runs: Sequence[int]) -> DataFrame | None:
        """The rows of folders, with the batch that wrote each. A day that was dropped everywhere leaves no file."""
        parts = []
        for kind, column, names in (("batches", "batch", batches), ("runs", "run", runs)):
            folders = [f"{self.path}/{kind}/{column}={name}" for name in names]
            filled = [f for f in folders if any(name.endswith(".parquet") or "=" in name for name in names_in(self.spark, f))]
            if filled:
                read = self.spark.read.option("basePath", f"{self.path}/{kind}").parquet(*filled)
                parts.append(read.withColumn("batch", F.col("batch").cast("bigint")).drop("run"))
        if not parts:
            return None
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _commit(self, generation: Generation) -> None:
        rows = [(generation.upto, name, level) for name, level in generation.runs]
        record = self.spark.createDataFrame(rows, "upto bigint, run bigint, level int").coalesce(1)
        record.write.mode("overwrite").parquet(f"{self.path}/generations/generation={generation.number}")

    def _generation(self, number: int) -> Generation:
        rows = self.spark.read.parquet(f"{self.path}/generations/generation={number}").collect()
        return Generation(number, rows[0].upto, tuple(sorted((row.run, row.level) for row in rows)))


def upsert_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends the batch to the table at ``path``."""
    return lambda batch, batch_id: KeyedTable(batch.sparkSession, path).write(batch, batch_id)


def read_latest(spark: SparkSession, path: str, keys: Sequence[str], schema: StructType | None = None) -> DataFrame:
    """The table: for each key the row of the last batch that wrote it."""
    return KeyedTable(spark, path, keys, schema=schema).rows()


def read_rows(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All rows ever written, for tables whose rows are never updated: no shuffle, and copies are kept.

    Each row of the source is in exactly one batch. Compact such a table without keys.
    """
    return KeyedTable(spark, path, schema=schema).rows()


def compact(spark: SparkSession, path: str, keys: Sequence[str], upto: int) -> None:
    """Folds all batches up to ``upto``. Call it for finished batches only."""
    KeyedTable(spark, path, keys).compact(upto)
