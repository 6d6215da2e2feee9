"""The log record, raw and typed, and the message envelope."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the log record, in file order.
LOG_FIELDS = (
    "timestamp",
    "source_ip",
    "dest_ip",
    "protocol",
    "action",
    "threat_label",
    "log_type",
    "bytes_transferred",
    "user_agent",
    "request_path",
)

# Text fields that need no conversion between the raw and the typed record.
TEXT_FIELDS = tuple(f for f in LOG_FIELDS if f not in ("timestamp", "bytes_transferred"))

# Folder columns of the day layout.
DAY_PARTS = ("year", "month", "day")

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in LOG_FIELDS])

TYPED_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        *(T.StructField(name, T.StringType()) for name in TEXT_FIELDS),
        T.StructField("bytes_transferred", T.LongType()),
    ]
)

ENVELOPE_SCHEMA = T.StructType(
    [T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())]
)
