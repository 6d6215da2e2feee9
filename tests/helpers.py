"""Small frames of the log record."""

import datetime as dt

from netwatch.schema import RAW_SCHEMA

TYPED = (
    "event_time timestamp, source_ip string, dest_ip string, protocol string, action string, "
    "threat_label string, log_type string, bytes_transferred bigint, user_agent string, request_path string"
)

DEFAULTS = {
    "event_time": dt.datetime(2024, 1, 5, 10, 0, 0),
    "source_ip": "10.0.0.1",
    "dest_ip": "192.168.0.1:443",
    "protocol": "HTTP",
    "action": "allowed",
    "threat_label": "benign",
    "log_type": "ids",
    "bytes_transferred": 100,
    "user_agent": "Mozilla/5.0",
    "request_path": "/index.html",
}


def logs(spark, *rows):
    """Typed rows; each is given as the fields that differ from the defaults."""
    return spark.createDataFrame([tuple({**DEFAULTS, **row}.values()) for row in rows], TYPED)


def raw(spark, *rows):
    texts = {**DEFAULTS, "event_time": "2024-01-05T10:00:00", "bytes_transferred": "100"}
    texts = {"timestamp" if k == "event_time" else k: v for k, v in texts.items()}
    return spark.createDataFrame([tuple({**texts, **row}.values()) for row in rows], RAW_SCHEMA)


def at(text):
    return dt.datetime.fromisoformat(text)


def values(df, *columns):
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=str)
