"""The committing store: failed, repeated and restarted writes."""

from functools import partial

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from netwatch.sinks.committed import FileStore, read_files, write_committed

SCHEMA = "id bigint, name string, at timestamp, tags map<string,string>"


class FailingStore(FileStore):
    """Fails behind its second batch of one task, on the first attempts or always."""

    def __init__(self, root, attempts):
        super().__init__(root)
        self.attempts = attempts

    def stage(self, run, name, batch):
        out = super().stage(run, name, batch)
        context = TaskContext.get()
        if context.partitionId() == 1 and name.endswith("-1") and context.attemptNumber() < self.attempts:
            raise OSError("lost")
        return out


@pytest.fixture
def frame(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    yield spark.range(0, 100, 1, 4).select(
        "id",
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("n\n"), "id")).alias("name"),
        F.timestamp_seconds(F.col("id") * 1_000).alias("at"),
        F.create_map(F.lit("k"), F.col("id").cast("string")).alias("tags"),
    )
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def rows(frame):
    return sorted((r.id, r.name, r.at, tuple(r.tags.items())) for r in frame.collect())


def stored(spark, folder, frame):
    return rows(read_files(spark, folder, frame.schema))


def test_rows_come_back(spark, folder, frame):
    assert stored(spark, folder, frame) == []
    write_committed(frame, partial(FileStore, folder))
    assert stored(spark, folder, frame) == rows(frame)
    write_committed(frame.filter("id < 5"), partial(FileStore, folder))
    assert len(stored(spark, folder, frame)) == 105


def test_a_run_started_again_replaces_itself(spark, folder, frame):
    for _ in range(2):
        write_committed(frame, partial(FileStore, folder), "monday")
    assert stored(spark, folder, frame) == rows(frame)
    write_committed(frame.filter("id < 5"), partial(FileStore, folder), "monday")
    assert len(stored(spark, folder, frame)) == 5
    assert len(FileStore(folder).paths()) == 1


def test_a_failing_job_shows_nothing(spark, folder, frame):
    write_committed(frame, partial(FileStore, folder), "monday")
    before = FileStore(folder).paths()
    for run in ("monday", "tuesday"):
        with pytest.raises(Exception, match="lost"):
            write_committed(frame, partial(FailingStore, folder, 99), run)
    assert FileStore(folder).paths() == before
    assert stored(spark, folder, frame) == rows(frame)


def test_staged_rows_of_other_attempts_are_not_shown(spark, folder, frame):
    """What an attempt that was lost has staged is neither read nor left behind."""
    lost = FileStore(folder)
    batch = frame.limit(3).toArrow().to_batches()[0]
    lost.stage("monday", "00001-7-lost-0", batch)
    assert stored(spark, folder, frame) == []
    write_committed(frame, partial(FileStore, folder), "monday")
    lost.discard("monday")
    assert stored(spark, folder, frame) == rows(frame)


def test_an_empty_frame_is_a_run(spark, folder, frame):
    write_committed(frame, partial(FileStore, folder), "monday")
    write_committed(frame.filter("false"), partial(FileStore, folder), "monday")
    assert stored(spark, folder, frame) == []
