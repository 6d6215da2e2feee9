"""From the raw text record to the typed one, and the columns derived from it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netwatch.functions.matching import attack_type, rule_flags
from netwatch.functions.text import bytes_number, dest_port, filled, row_key
from netwatch.functions.times import event_day, hour_bucket, parse_time, time_text
from netwatch.schema import DAY_PARTS, LOG_FIELDS, TEXT_FIELDS


def typed_logs(
    raw: DataFrame, fmt: str | None = None, default_time: dt.datetime | None = None
) -> DataFrame:
    """Text record to typed record, bound by column name.

    Unreadable times and byte counts become NULL, empty text becomes NULL, fields that the log does
    not have are dropped; other columns listed in the day layout, and ``event_id``, are kept.
    """
    missing = [name for name in LOG_FIELDS if name not in raw.columns]
    if missing:
        raise ValueError(f"log fields missing from the input: {', '.join(missing)}")
    kept = [c for c in ("event_id", *DAY_PARTS) if c in raw.columns]
    return raw.select(
        parse_time(filled(F.col("timestamp")), fmt, default_time).alias("event_time"),
        *(filled(F.col(name)).alias(name) for name in TEXT_FIELDS),
        bytes_number(F.col("bytes_transferred")).alias("bytes_transferred"),
        *kept,
    )


def raw_logs(logs: DataFrame) -> DataFrame:
    """Typed record to the ten text fields, in file order; ``event_id`` is kept where present."""
    kept = [c for c in ("event_id",) if c in logs.columns]
    fields = {name: F.col(name) for name in TEXT_FIELDS}
    fields["timestamp"] = time_text(F.col("event_time"))
    fields["bytes_transferred"] = F.col("bytes_transferred").cast("string")
    return logs.select(*(fields[name].alias(name) for name in LOG_FIELDS), *kept)


def enrich(logs: DataFrame, port_null_as: str | None = None) -> DataFrame:
    """Adds the event day, the hour, the destination port and the timeline key."""
    hour = hour_bucket(F.col("event_time"))
    return logs.select(
        "*",
        event_day(F.col("event_time")).alias("detection_date"),
        event_day(F.col("event_time")).alias("partition_date"),
        hour.alias("hour"),
        dest_port(F.col("dest_ip"), port_null_as).alias("dest_port"),
        row_key(F.col("threat_label"), hour).alias("row_key"),
    )


def flag_rules(logs: DataFrame, rule_set: Mapping[str, str], column: str = "request_path") -> DataFrame:
    """Adds one 0/1 column per rule."""
    return logs.select("*", *rule_flags(F.col(column), rule_set))


def classify_attack(
    logs: DataFrame, rule_set: Mapping[str, str], column: str = "request_path"
) -> DataFrame:
    """Adds ``attack_type``: the first rule that matches, or Normal."""
    return logs.withColumn("attack_type", attack_type(F.col(column), rule_set))
