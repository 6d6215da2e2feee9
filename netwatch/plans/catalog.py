"""The registered queries: each takes a session and a table folder and reads the whole events table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netwatch import rules
from netwatch.functions.scores import label_weight
from netwatch.functions.text import dest_port
from netwatch.functions.times import day_from_path, parse_time
from netwatch.operators import days, detectors, enrich, filters, keyed, serving, shaping, split, views
from netwatch.plans import increments
from netwatch.session import work_dir
from netwatch.sinks.committed import FileStore, read_files, write_committed
from netwatch.sinks.days import write_by_day, write_view
from netwatch.sources.envelope import decode_envelope, encode_envelope
from netwatch.sources.events import logs_view, read_events, stream_events
from netwatch.sources.logs import read_day, read_logs, read_raw, read_text_logs, stored_days
from netwatch.sources.marks import write_hwm
from netwatch.sources.stream import read_stream
from netwatch.streaming.runs import TABLE_KEYS, alert_table, run_detectors
from netwatch.streaming.tables import KeyedTable

Query = Callable[[SparkSession, str], DataFrame]

# Constants stand in for the clock, so that results can be compared.
AS_OF = "2024-02-01 00:00:00"
DAY = "2024-01-30"
MARK = "2024-01-20"
EXPIRY = "2024-01-30 12:00:00"
MARKER = "2024-01-27"
# Files of a message stream, and growing writes of a table.
SLICES = 8
# Thirty days become twelve hours for the windowed detectors.
FAST = 60
ORDER = ("event_time", "event_id")
EARLY = f"CAST(event_time AS DATE) <= DATE '{MARK}'"
# Bounds a micro-batch over a table of very many files.
FILES_PER_TRIGGER = 10_000


def _logs(spark: SparkSession, folder: str, time_div: int = 1) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return logs_view(read_events(spark, folder), time_div)


def _on_logs(operator: Callable[[DataFrame], DataFrame], time_div: int = 1) -> Query:
    return lambda spark, folder: operator(_logs(spark, folder, time_div))


def _text_logs(logs: DataFrame) -> DataFrame:
    """Raw text with both time spellings and an unreadable one."""
    n = F.col("event_id") % 19
    text = F.when(n == 0, "bad").when(n == 1, F.replace("timestamp", F.lit("T"), F.lit(" ")))
    return enrich.raw_logs(logs).withColumn("timestamp", text.otherwise(F.col("timestamp")))


def _log_enriched(logs: DataFrame) -> DataFrame:
    typed = enrich.enrich(enrich.typed_logs(_text_logs(logs)), port_null_as="")
    return typed.select(
        "event_id", "event_time", "detection_date", "partition_date", "hour",
        "dest_port", "bytes_transferred", "row_key",
    )


def _ports(logs: DataFrame) -> DataFrame:
    port = dest_port(F.col("dest_ip")).alias("dest_port")
    return logs.groupBy(port).agg(F.count(F.lit(1)).alias("event_count"))


def _flags(rule_set: dict[str, str]) -> Query:
    def flagged(logs: DataFrame) -> DataFrame:
        rows = enrich.classify_attack(enrich.flag_rules(logs, rule_set), rule_set)
        return rows.select("event_id", *rule_set, "attack_type")

    return _on_logs(flagged)


def _attacks(logs: DataFrame) -> DataFrame:
    found = filters.attacks_only(enrich.classify_attack(logs, rules.BATCH_B))
    return found.select("event_id", "attack_type")


def _facts(logs: DataFrame) -> DataFrame:
    return logs.select("event_id", "event_time", "source_ip", "threat_label")


def _valid_days(logs: DataFrame) -> DataFrame:
    kept, rejected = filters.valid_days(_text_logs(logs).select("event_id", "timestamp"))
    return kept.withColumn("accepted", F.lit(True)).unionByName(
        rejected.withColumn("accepted", F.lit(False))
    )


def _serving(spark: SparkSession, folder: str) -> DataFrame:
    logs = _logs(spark, folder, FAST)
    scores = serving.latest_scores(detectors.ip_scores(logs))
    return serving.serving_ip_risk(views.ip_reputation(logs), scores)


def _upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of the first three quarters of the log, updated by those of the last quarter."""
    head, tail = split.ordered_split(_logs(spark, folder, FAST), ORDER)
    return keyed.upsert_latest(
        detectors.ip_scores(head), detectors.ip_scores(tail), ["source_ip", "window_start"]
    )


def _versions(logs: DataFrame) -> DataFrame:
    """The newest events of each source; a third of all rows share one source."""
    rows = logs.select("source_ip", "event_time", "event_id")
    return keyed.keep_versions(rows, ["source_ip"], ORDER, rules.PATTERN_VERSIONS)


def _expire(logs: DataFrame) -> DataFrame:
    return keyed.expire(_facts(logs), "event_time", rules.THREAT_TTL_SECONDS, EXPIRY)


def _merged(logs: DataFrame) -> DataFrame:
    """Counts made per day, then merged."""
    daily = logs.groupBy(F.to_date("event_time").alias("day"), "source_ip").agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(F.col("threat_label") != rules.BENIGN).alias("threat_count"),
    )
    return views.rate_reputation(views.merge_reputation(daily))


def _split(logs: DataFrame) -> DataFrame:
    head, tail = split.ordered_split(logs.select("event_id", "event_time", "bytes_transferred"), ORDER)
    return head.withColumn("part", F.lit("batch")).unionByName(tail.withColumn("part", F.lit("stream")))


def _split_with_ties(logs: DataFrame) -> DataFrame:
    """Sizes and ends of both parts, when all that orders the rows is their hour."""
    rows = logs.select("event_id", F.date_trunc("hour", "event_time").alias("hour"))
    head, tail = split.ordered_split(rows, ["hour"])
    parts = head.withColumn("part", F.lit("batch")).unionByName(tail.withColumn("part", F.lit("stream")))
    ends = (F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"))
    return parts.groupBy("part").agg(F.count_distinct("event_id").alias("event_count"), *ends)


def _chunks(logs: DataFrame) -> DataFrame:
    return split.replay_chunks(logs.select("event_id", "event_time"), ORDER)


def _cells(logs: DataFrame) -> DataFrame:
    """Cells of the reputation and of the timeline view."""
    risk = views.ip_reputation(logs)
    hours = views.threat_timeline(logs)
    measures = ("total_requests", "threat_count", "threat_score", "risk_level")
    return shaping.to_cells(risk, "row_key", "info", dict(zip(measures, measures))).unionByName(
        shaping.to_cells(
            hours, "row_key", "data", {"event_count": "event_count", "total_bytes": "total_bytes"}
        )
    )


def _points(logs: DataFrame) -> DataFrame:
    """Points of the reputation view."""
    return shaping.to_points(
        views.ip_reputation(logs, day=DAY),
        "ip_reputation",
        ["source_ip"],
        ["total_requests", "threat_count", "threat_score", "risk_level"],
        "detection_date",
    )


def _opened(points: DataFrame) -> DataFrame:
    """Points with their maps opened into columns."""
    return points.select(
        "measurement",
        F.try_element_at("tags", F.lit("source_ip")).alias("tag_source_ip"),
        F.size("tags").alias("tag_count"),
        F.try_element_at("longs", F.lit("total_requests")).alias("total_requests"),
        F.try_element_at("longs", F.lit("threat_count")).alias("threat_count"),
        F.try_element_at("doubles", F.lit("threat_score")).alias("threat_score"),
        F.try_element_at("strings", F.lit("risk_level")).alias("risk_level"),
        "time",
    )


def _published(shape: Callable[[DataFrame], DataFrame]) -> Query:
    """Rows for a store, written twice as the same run, as by a job that is started again, and read back."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        root = work_dir(spark, "store")
        rows = shape(_logs(spark, folder))
        for _ in range(2):
            write_committed(rows, partial(FileStore, root), "views")
        return read_files(spark, root, rows.schema)

    return run


def _round_trip(logs: DataFrame) -> DataFrame:
    return decode_envelope(encode_envelope(logs))


def _clustered(logs: DataFrame) -> DataFrame:
    rows = logs.select("source_ip", "event_time", "event_id")
    return keyed.clustered(rows, "source_ip", [F.desc("event_time"), F.desc("event_id")])


def _write_days(spark: SparkSession, logs: DataFrame, base: str | None = None, **options) -> str:
    """Writes a log as day folders of CSV and returns their base."""
    base = base or work_dir(spark, "days")
    write_by_day(enrich.raw_logs(logs).drop("event_id"), base, **options)
    return base


def _on_days(operator: Callable[[SparkSession, str], DataFrame]) -> Query:
    """A query on the whole log written as day folders."""
    return lambda spark, folder: operator(spark, _write_days(spark, _logs(spark, folder)))


def _dynamic_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """Days after the mark are written again with half their events; the other days stay."""
    logs = _logs(spark, folder)
    base = _write_days(spark, logs)
    _write_days(spark, filters.after_mark(logs, MARK).filter("event_id % 2 = 0"), base, overwrite="dynamic")
    return days.day_summary(read_logs(spark, base))


def _incremental(view: Callable[[SparkSession, str], DataFrame], first: str, **options) -> Query:
    """One part of the log is written and run, then the rest; the view is merged."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        base, state = work_dir(spark, "days"), work_dir(spark, "state")
        logs = _logs(spark, folder)
        for part in (first, f"NOT ({first})"):
            _write_days(spark, logs.filter(part), base)
            increments.run_incremental(spark, base, state, as_of=AS_OF, **options)
        return view(spark, state)

    return run


def _run_days(spark: SparkSession, base: str) -> DataFrame:
    """The days after a marker, one after the other."""
    state = work_dir(spark, "state")
    write_hwm(spark, f"{state}/mark", MARKER)
    increments.run_days(spark, base, state)
    return increments.merged_patterns(spark, state).drop("last_seen")


def _pending_folders(spark: SparkSession, base: str) -> DataFrame:
    return days.days_after(days.list_days(stored_days(spark, base)), MARK)


def _raw_inferred(spark: SparkSession, base: str) -> DataFrame:
    rows = read_raw(spark, base, infer=True)
    size = F.sum("bytes_transferred").cast("bigint").alias("total_bytes")
    return rows.agg(F.count(F.lit(1)).alias("event_count"), size, F.max("timestamp").alias("newest"))


def _days_of_paths(spark: SparkSession, base: str) -> DataFrame:
    return read_text_logs(spark, base).groupBy(day_from_path().alias("day")).agg(F.count(F.lit(1)).alias("event_count"))


def _view_parquet(spark: SparkSession, folder: str) -> DataFrame:
    path = work_dir(spark, "view")
    write_view(views.ip_reputation(_logs(spark, folder)), path)
    return spark.read.parquet(path)


def _default_time(logs: DataFrame) -> DataFrame:
    time = parse_time(F.col("timestamp"), default=dt.datetime.fromisoformat(AS_OF))
    return _text_logs(logs).select("event_id", time.alias("event_time"))


def _formatted_time(logs: DataFrame) -> DataFrame:
    fmt = "yyyy-MM-dd'T'HH:mm:ss"
    return logs.select("event_id", parse_time(F.date_format("event_time", fmt), fmt).alias("event_time"))


def _is_empty(spark: SparkSession, folder: str) -> DataFrame:
    logs = _logs(spark, folder)
    found = (days.is_empty(logs), days.is_empty(logs.filter("threat_label = 'unknown'")))
    return spark.createDataFrame([found], "log_empty boolean, unknown_empty boolean")


def _versions_of_patterns(spark: SparkSession, folder: str) -> DataFrame:
    """A table of attack counts that is written again as the log grows, and keeps the last versions of each."""
    logs = _logs(spark, folder)
    table = KeyedTable(
        spark, work_dir(spark, "patterns"), ["attack_type", "detection_date"], versions=rules.PATTERN_VERSIONS, fan_in=2
    )
    for batch in range(SLICES):
        grown = logs.filter(F.col("event_id") % SLICES <= batch)
        table.write(views.attack_patterns(grown, rules.BATCH_B, last_seen=False), batch)
        if batch % 2:
            table.compact(batch)
    return table.rows()


def _messages(spark: SparkSession, folder: str, time_div: int) -> DataFrame:
    """The log as a stream of message files, one for each micro-batch."""
    path = work_dir(spark, "messages")
    encode_envelope(_logs(spark, folder, time_div)).repartition(SLICES).write.parquet(path)
    return decode_envelope(read_stream(spark, "parquet", path=path, maxFilesPerTrigger="1"))


def _run_to_end(spark: SparkSession, logs: DataFrame, root: str, tables: list[str], **options) -> None:
    queries = run_detectors(
        spark,
        logs,
        f"{root}/tables",
        f"{root}/checkpoints",
        tables=tables,
        trigger={"availableNow": True},
        as_of=AS_OF,
        state_partitions=spark.sparkContext.defaultParallelism,
        **options,
    )
    for query in queries.values():
        query.awaitTermination()


def _stream(table: str) -> Query:
    """One detector as a stream over the events table, run to its end; the table is read back."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        root = work_dir(spark, "stream")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        messages = encode_envelope(logs_view(stream_events(spark, folder, FILES_PER_TRIGGER), FAST))
        _run_to_end(spark, decode_envelope(messages), root, [table])
        return alert_table(spark, f"{root}/tables", table).rows().drop("event_key")

    return run


def _compacted_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of a stream whose table is compacted every other batch."""
    root = work_dir(spark, "stream")
    _run_to_end(spark, _messages(spark, folder, FAST), root, ["ip_threat_scores"], compact_every=2)
    return alert_table(spark, f"{root}/tables", "ip_threat_scores").rows()


def _live_threats(spark: SparkSession, folder: str) -> DataFrame:
    """Signature rows of a stream that are alive at a time; the days before it are dropped as folders."""
    root = work_dir(spark, "stream")
    table = alert_table(spark, f"{root}/tables", "realtime_threats", written_at="event_time")
    _run_to_end(spark, _messages(spark, folder, 1), root, ["realtime_threats"], sink=lambda _: table.sink())
    table.compact(SLICES - 2)
    table.drop_expired(dt.datetime.fromisoformat(EXPIRY))
    return table.rows(as_of=EXPIRY).drop("event_key")


def _four_streams(spark: SparkSession, folder: str) -> DataFrame:
    """All detectors at once over a message stream: rows and sources of each table."""
    root = work_dir(spark, "stream")
    _run_to_end(spark, _messages(spark, folder, FAST), root, list(TABLE_KEYS))
    sizes = [
        alert_table(spark, f"{root}/tables", name).rows().agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("source_ip").alias("source_count"),
        )
        for name in TABLE_KEYS
    ]
    return reduce(DataFrame.unionByName, sizes)


def _stream_port_scans(spark: SparkSession, folder: str) -> DataFrame:
    root = work_dir(spark, "stream")
    table = KeyedTable(spark, f"{root}/table", ["source_ip", "window_start"])
    scans = views.port_scans(_messages(spark, folder, FAST), min_ports=10)
    writer = scans.writeStream.outputMode("update").foreachBatch(table.sink(2)).option("checkpointLocation", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return table.rows()


QUERIES: dict[str, Query] = {
    # Batch views.
    "ip_reputation": _on_logs(lambda logs: views.ip_reputation(logs, day=DAY, risk=False)),
    "ip_reputation_risk": _on_logs(views.ip_reputation),
    "attack_patterns_a": _on_logs(lambda logs: views.attack_patterns(logs, rules.BATCH_A, last_seen=False)),
    "attack_patterns_b": _on_logs(lambda logs: views.attack_patterns(logs, rules.BATCH_B, as_of=AS_OF)),
    "threat_timeline": _on_logs(lambda logs: views.threat_timeline(logs, with_bytes=False)),
    "threat_timeline_bytes": _on_logs(views.threat_timeline),
    # Projections.
    "log_enriched": _on_logs(_log_enriched),
    "dest_port": _on_logs(_ports),
    "rule_flags_a": _flags(rules.BATCH_A),
    "rule_flags_b": _flags(rules.BATCH_B),
    "label_weight": _on_logs(lambda logs: logs.select("event_id", label_weight(F.col("threat_label")).alias("weight"))),
    # Filters.
    "attacks_only": _on_logs(_attacks),
    "threats_only": _on_logs(lambda logs: _facts(filters.threats_only(logs))),
    "failed_access": _on_logs(lambda logs: _facts(filters.failed_access(logs))),
    "signature_rows": _on_logs(lambda logs: _facts(filters.signature_rows(logs))),
    "after_mark": _on_logs(lambda logs: _facts(filters.after_mark(logs, MARK))),
    "valid_days": _on_logs(_valid_days),
    # Detectors on a static frame.
    "detect_brute_force": _on_logs(lambda logs: detectors.detect_brute_force(logs, as_of=AS_OF), FAST),
    "detect_signatures": _on_logs(lambda logs: detectors.detect_signatures(logs, as_of=AS_OF), FAST),
    "detect_data_exfil": _on_logs(lambda logs: detectors.detect_data_exfil(logs, as_of=AS_OF), FAST),
    "ip_scores": _on_logs(detectors.ip_scores, FAST),
    # Reports.
    "top_ips": _on_logs(views.top_ips),
    "volume_analysis": _on_logs(views.volume_analysis),
    "port_scans": _on_logs(lambda logs: views.port_scans(logs, min_ports=10), FAST),
    "serving_ip_risk": _serving,
    # Keyed tables.
    "upsert_latest": _upsert,
    "keep_versions": _on_logs(_versions),
    "expire": _on_logs(_expire),
    # Control.
    "max_day": _on_logs(days.max_day),
    "day_summary": _on_logs(days.day_summary),
    "day_count": _on_logs(days.day_count),
    "pending_days": _on_logs(lambda logs: days.days_after(days.list_days(logs), MARK)),
    "merged_reputation": _on_logs(_merged),
    "incremental_reputation": _incremental(increments.merged_reputation, EARLY),
    "incremental_patterns": _incremental(increments.merged_patterns, EARLY),
    "incremental_timeline": _incremental(increments.merged_timeline, EARLY),
    "late_files": _incremental(increments.merged_reputation, "event_id % 3 > 0"),
    "repartitioned_increment": _incremental(increments.merged_patterns, EARLY, partitions=4),
    "run_days": _on_days(_run_days),
    "pending_folders": _on_days(_pending_folders),
    "is_empty": _is_empty,
    "versions_of_patterns": _versions_of_patterns,
    # Files.
    "read_day": _on_days(lambda spark, base: read_day(spark, f"{base}/year=2024/month=01/day=30")),
    "read_glob": _on_days(lambda spark, base: read_logs(spark, f"{base}/year=2024/month=01/day=1*")),
    "raw_inferred": _on_days(_raw_inferred),
    "day_from_path": _on_days(_days_of_paths),
    "dynamic_overwrite": _dynamic_overwrite,
    "view_parquet": _view_parquet,
    "default_time": _on_logs(_default_time),
    "formatted_time": _on_logs(_formatted_time),
    # Shaping.
    "ordered_split": _on_logs(_split),
    "split_with_ties": _on_logs(_split_with_ties),
    "replay_chunks": _on_logs(_chunks),
    "cells": _on_logs(_cells),
    "points": _on_logs(lambda logs: _opened(_points(logs))),
    "published_cells": _published(_cells),
    "published_points": lambda spark, folder: _opened(_published(_points)(spark, folder)),
    "envelope_round_trip": _on_logs(_round_trip),
    "clustered": _on_logs(_clustered),
    "day_folders": _on_days(read_logs),
    # Streams.
    "stream_brute_force": _stream("brute_force_alerts"),
    "stream_signatures": _stream("realtime_threats"),
    "stream_data_exfil": _stream("data_exfil_alerts"),
    "stream_ip_scores": _stream("ip_threat_scores"),
    "stream_port_scans": _stream_port_scans,
    "four_streams": _four_streams,
    "compacted_scores": _compacted_scores,
    "live_threats": _live_threats,
}
