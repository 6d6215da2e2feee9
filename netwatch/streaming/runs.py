"""Running the detectors: one query each, with its own checkpoint and table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from netwatch import rules
from netwatch.functions.identity import row_hash
from netwatch.operators.detectors import (
    AsOf,
    detect_brute_force,
    detect_data_exfil,
    detect_signatures,
    ip_scores,
)
from netwatch.schema import TYPED_SCHEMA
from netwatch.streaming.tables import KeyedTable

# The tables and their keys. Events that share source and time are kept apart by a hash.
TABLE_KEYS = {
    "brute_force_alerts": ("source_ip", "window_start"),
    "realtime_threats": ("source_ip", "event_time", "event_key"),
    "data_exfil_alerts": ("source_ip", "window_start"),
    "ip_threat_scores": ("source_ip", "window_start"),
}

# The table whose rows expire, by which time, and after how many seconds. Its copies of a row are kept.
EXPIRING = {"realtime_threats": ("window_start", rules.THREAT_TTL_SECONDS)}
# Batches between two compactions of a table.
COMPACT_EVERY = 16

# State outside the Java heap, checkpointed as changes instead of as whole snapshots.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def detector_tables(logs: DataFrame, as_of: AsOf = None) -> dict[str, DataFrame]:
    """The four alert tables over one log frame, static or streaming."""
    threats = detect_signatures(logs, as_of=as_of)
    stamps = ("window_start", "window_end")
    facts = [c for c in threats.columns if c not in stamps]
    return {
        "brute_force_alerts": detect_brute_force(logs, as_of=as_of),
        "realtime_threats": threats.withColumn("event_key", row_hash(threats, facts)),
        "data_exfil_alerts": detect_data_exfil(logs, as_of=as_of),
        "ip_threat_scores": ip_scores(logs),
    }


def alert_table(spark: SparkSession, root: str, name: str, **options) -> KeyedTable:
    """The table of that name below ``root``; it can be read before anything was written."""
    schema = detector_tables(spark.createDataFrame([], TYPED_SCHEMA))[name].schema
    if name in EXPIRING:
        written_at, ttl = EXPIRING[name]
        options = {"written_at": written_at, "ttl_seconds": ttl} | options
    else:
        options = {"keys": TABLE_KEYS[name]} | options
    return KeyedTable(spark, f"{root}/{name}", schema=schema, **options)


def with_lateness(logs: DataFrame, delay: str | None = None) -> DataFrame:
    """Bounds the state by a watermark. Rows later than ``delay`` may be lost; None keeps all rows."""
    return logs if delay is None else logs.withWatermark("event_time", delay)


def run_detectors(
    spark: SparkSession,
    logs: DataFrame,
    root: str,
    checkpoint: str,
    tables: Sequence[str] = tuple(TABLE_KEYS),
    trigger: Mapping[str, object] | None = None,
    as_of: AsOf = None,
    state_partitions: int | None = None,
    sink: Callable[[str], Callable[[DataFrame, int], None]] | None = None,
    compact_every: int | None = COMPACT_EVERY,
) -> dict[str, StreamingQuery]:
    """Starts one query per table in update mode and returns them by table.

    Tables are written below ``root`` unless ``sink`` gives another ``foreachBatch`` function for a
    table; every ``compact_every`` batches they are compacted, and days past their time are dropped. The number of state partitions is fixed by the first run of a checkpoint, so choose it
    for the cluster; by default it is the session's number of shuffle partitions. State is kept in
    RocksDB, outside the Java heap, since without a watermark it never expires.
    """
    sink = sink or (lambda table: alert_table(spark, root, table).sink(compact_every))
    settings = dict(STATE_SETTINGS)
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    frames = detector_tables(logs, as_of)
    started = {}
    try:
        with _settings(spark, settings):
            for table in tables:
                writer = frames[table].writeStream.outputMode("update")
                writer = writer.foreachBatch(sink(table)).option("checkpointLocation", f"{checkpoint}/{table}")
                if trigger:
                    writer = writer.trigger(**trigger)
                started[table] = writer.start()
    except Exception:
        for query in started.values():
            query.stop()
        raise
    return started


def await_any(spark: SparkSession, queries: Mapping[str, StreamingQuery]) -> None:
    """Waits until any of these queries ends, then stops the others; a failure is raised.

    Other queries of the session, ended or not, do not count.
    """
    try:
        while not any(query.awaitTermination(1) for query in queries.values()):
            pass
    finally:
        for query in queries.values():
            query.stop()


@contextmanager
def _settings(spark: SparkSession, settings: Mapping[str, str]):
    """A query copies the session's settings when it starts; they are put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
