"""Stores that are written through a client, one connection per partition."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from typing import Any, Protocol

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row

# Rows per batch of cells, and points per write.
CELL_BATCH = 1000
POINT_BATCH = 3000


class Client(Protocol):
    """What a store has to offer. ``put`` must be repeatable: a lost task is run again."""

    def put(self, rows: list[dict[str, Any]]) -> None: ...

    def close(self) -> None: ...


def write_partitions(
    df: DataFrame, client_factory: Callable[[], Client], batch_size: int = CELL_BATCH
) -> None:
    """Sends each partition through its own client, ``batch_size`` rows at a time.

    A failing put fails the task, and after Spark's retries the job.
    """

    def send(rows: Iterator[Row]) -> None:
        client = client_factory()
        try:
            while batch := list(islice(rows, batch_size)):
                client.put([row.asDict(recursive=True) for row in batch])
        finally:
            client.close()

    df.foreachPartition(send)


def fan_out(df: DataFrame, sinks: Sequence[Callable[[DataFrame], None]]) -> None:
    """Writes one view to several sinks, computing it once. The first failure is raised."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for sink in sinks:
            sink(df)
    finally:
        df.unpersist()
