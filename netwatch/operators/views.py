"""Batch views: reputation, attack patterns, timeline, and the reports on them.

All group by hash aggregation, whose map side collapses a hot key to one row per task before the
shuffle. Counts are kept as integers and ratios are derived last, so increments merge exactly.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netwatch import rules
from netwatch.functions.scores import risk_level, threat_ratio, wide_sum
from netwatch.functions.text import port_number, row_key
from netwatch.functions.times import event_day, hour_bucket, lit_day, stamp
from netwatch.operators.enrich import classify_attack
from netwatch.operators.filters import at_least, attacks_only

# Keys of the views, and the grouping number that Spark gives each: one bit per key, set when unused.
VIEW_KEYS = {
    "ip_reputation": ["source_ip"],
    "attack_patterns": ["attack_type", "detection_date"],
    "threat_timeline": ["hour", "threat_label"],
}
VIEW_NUMBERS = {"ip_reputation": 0b01111, "attack_patterns": 0b10011, "threat_timeline": 0b11100}


def reputation_counts(logs: DataFrame) -> DataFrame:
    """Requests and threats per source. A NULL label is no threat; NULL sources form one group."""
    return logs.groupBy("source_ip").agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(F.col("threat_label") != rules.BENIGN).alias("threat_count"),
    )


def merge_reputation(counts: DataFrame) -> DataFrame:
    """Adds up the counts of several days or increments."""
    return counts.groupBy("source_ip").agg(
        F.sum("total_requests").alias("total_requests"),
        F.sum("threat_count").alias("threat_count"),
    )


def rate_reputation(counts: DataFrame, day: str | None = None, risk: bool = True) -> DataFrame:
    """Ratio, risk level and key from counts; their day is given, or a column of theirs, or left out."""
    score = threat_ratio(F.col("threat_count"), F.col("total_requests"))
    columns = ["source_ip", "total_requests", "threat_count", score.alias("threat_score")]
    if risk:
        columns.append(risk_level(score).alias("risk_level"))
    columns.append(F.col("source_ip").alias("row_key"))
    if day is not None:
        columns.append(lit_day(day).alias("detection_date"))
    elif "detection_date" in counts.columns:
        columns.append("detection_date")
    return counts.select(*columns)


def ip_reputation(logs: DataFrame, day: str | None = None, risk: bool = True) -> DataFrame:
    return rate_reputation(reputation_counts(logs), day, risk)


def attack_patterns(
    logs: DataFrame,
    rule_set: Mapping[str, str] = rules.BATCH_B,
    last_seen: bool = True,
    as_of: dt.datetime | str | None = None,
) -> DataFrame:
    """Attacks per type and day; ``last_seen`` is the latest processing time."""
    attacks = attacks_only(classify_attack(logs, rule_set)).select(
        "attack_type", event_day(F.col("event_time")).alias("detection_date")
    )
    measures = [F.count(F.lit(1)).alias("attack_count")]
    if last_seen:
        measures.append(F.max(stamp(as_of)).alias("last_seen"))
    counted = attacks.groupBy("attack_type", "detection_date").agg(*measures)
    return counted.withColumn("row_key", row_key(F.col("attack_type"), F.col("detection_date")))


def threat_timeline(logs: DataFrame, with_bytes: bool = True) -> DataFrame:
    """Events per hour and label, with the bytes they moved."""
    measures = [F.count(F.lit(1)).alias("event_count")]
    if with_bytes:
        measures.append(wide_sum(F.col("bytes_transferred")).cast("double").alias("total_bytes"))
    hourly = logs.groupBy(hour_bucket(F.col("event_time")).alias("hour"), "threat_label")
    return hourly.agg(*measures).withColumn("row_key", row_key(F.col("threat_label"), F.col("hour")))


def count_views(
    logs: DataFrame,
    rule_set: Mapping[str, str] = rules.BATCH_B,
    as_of: dt.datetime | str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """The raw counts behind all three views in one pass over the log, told apart by ``view``.

    With ``by`` they are counted for each value of these columns.

    Grouping sets feed each row to the three groupings in the same stage, so the log is neither read
    again nor cached, and its rules are matched once. See ``VIEW_NUMBERS`` for the values of ``view``.
    """
    rows = classify_attack(logs, rule_set).select(
        *by,
        "source_ip",
        "attack_type",
        event_day(F.col("event_time")).alias("detection_date"),
        hour_bucket(F.col("event_time")).alias("hour"),
        "threat_label",
        "bytes_transferred",
        (F.col("threat_label") != rules.BENIGN).alias("is_threat"),
    )
    keys = [*by, *(key for group in VIEW_KEYS.values() for key in group)]
    return rows.groupingSets([[*by, *group] for group in VIEW_KEYS.values()], *keys).agg(
        F.grouping_id().cast("int").alias("view"),
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("is_threat")).alias("threats"),
        wide_sum(F.col("bytes_transferred")).alias("bytes"),
        F.max(stamp(as_of)).alias("processed_at"),
    )


def top_ips(logs: DataFrame, n: int = 10, label: str = "malicious") -> DataFrame:
    """The n sources with the most events of the label; equal counts go by address."""
    return (
        logs.filter(F.col("threat_label") == label)
        .groupBy("source_ip")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.desc("event_count"), F.asc_nulls_first("source_ip"))
        .limit(n)
    )


def volume_analysis(logs: DataFrame) -> DataFrame:
    """Data volume per threat label. The mean is a quotient of the sum and a count."""
    size = F.col("bytes_transferred")
    return (
        logs.groupBy("threat_label")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            wide_sum(size).alias("total_bytes"),
            F.max(size).alias("max_bytes"),
            F.count(size).alias("_sized"),
        )
        .select(
            "threat_label",
            "event_count",
            "total_bytes",
            (F.col("total_bytes") / F.nullif(F.col("_sized"), F.lit(0))).alias("avg_bytes"),
            "max_bytes",
        )
    )


def _bits_set(port: str) -> Column:
    """Aggregate: the number of different ports. Ports from 0 on are bits from 1 on, half of them in each bitmap."""
    bit = F.col(port).cast("bigint") + 1
    half = F.bitmap_bucket_number(bit)
    return sum(F.bitmap_count(F.bitmap_construct_agg(F.when(half == n, F.bitmap_bit_position(bit)))) for n in (1, 2))


def port_scans(logs: DataFrame, window: str = "1 hour", min_ports: int = 20) -> DataFrame:
    """Sources that reach at least ``min_ports`` different destination ports within a window.

    A batch counts distinct ports in two shuffled steps, by (source, window, port) and then by
    (source, window), so a hot source is spread over its ports. A stream cannot count distinct: it sets one
    bit per port instead, in two bitmaps of 4 KB, which task and state merge. Only valid ports count.
    """
    port = port_number(F.col("dest_ip")).alias("port")
    distinct: Column = _bits_set("port") if logs.isStreaming else F.count_distinct("port")
    per_window = (
        logs.select("source_ip", "event_time", port)
        .groupBy(F.window("event_time", window).alias("win"), "source_ip")
        .agg(distinct.cast("bigint").alias("distinct_ports"), F.count("port").alias("event_count"))
    )
    scans = per_window.select(
        "source_ip", F.col("win.start").alias("window_start"), "distinct_ports", "event_count"
    )
    return at_least(scans, "distinct_ports", min_ports)
