"""The keyed JSON message: log rows to messages and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netwatch import rules
from netwatch.operators.enrich import raw_logs, typed_logs
from netwatch.schema import LOG_FIELDS, RAW_SCHEMA


def encode_envelope(logs: DataFrame) -> DataFrame:
    """Typed rows to ``key, value``: the source address, and the record as JSON with all its fields."""
    record = F.to_json(F.struct(*LOG_FIELDS), {"ignoreNullFields": "false"})
    return raw_logs(logs).select(
        F.coalesce(F.col("source_ip"), F.lit(rules.NO_SOURCE)).cast("binary").alias("key"),
        record.cast("binary").alias("value"),
    )


def decode_envelope(messages: DataFrame) -> DataFrame:
    """Messages to typed rows. Unreadable JSON leaves a row of NULLs.

    The record is unfolded by a generator: filters on its fields then stay above it, and the JSON is
    parsed once per message instead of once for each field that a filter or a projection names.
    """
    record = F.from_json(F.col("value").cast("string"), RAW_SCHEMA)
    return typed_logs(messages.select(F.inline(F.array(record))))
