"""The four detectors, written once for static and for streaming frames.

The windowed three keep integer sums in their state, so a replayed or differently ordered stream ends
with the values a batch run gives.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netwatch import rules
from netwatch.functions.matching import signature_type
from netwatch.functions.scores import capped_score, is_blocked, mean_weight, wide_sum
from netwatch.functions.times import stamp
from netwatch.operators.filters import above, at_least, failed_access, signature_rows

AsOf = dt.datetime | str | None


def per_source(logs: DataFrame, length: str, *measures: Column) -> DataFrame:
    """Measures per source and tumbling window. Events without a time fall into no window."""
    frame = F.window("event_time", length)
    grouped = logs.groupBy(frame.alias("win"), "source_ip").agg(*measures)
    return grouped.withColumn("window_start", F.col("win.start")).drop("win")


def detect_brute_force(
    logs: DataFrame,
    window: str = rules.BRUTE_FORCE_WINDOW,
    threshold: int = rules.FAILED_MIN,
    as_of: AsOf = None,
) -> DataFrame:
    """Sources with at least ``threshold`` failed accesses in a window."""
    attempts = per_source(failed_access(logs), window, F.count(F.lit(1)).alias("failed_count"))
    return at_least(attempts, "failed_count", threshold).select(
        "source_ip",
        "window_start",
        "failed_count",
        capped_score(F.col("failed_count"), rules.FAILED_SCALE).alias("threat_score"),
        stamp(as_of).alias("detected_at"),
    )


def detect_data_exfil(
    logs: DataFrame,
    window: str = rules.EXFIL_WINDOW,
    threshold: int = rules.EXFIL_BYTES,
    as_of: AsOf = None,
) -> DataFrame:
    """Sources that move more than ``threshold`` bytes in a window."""
    volumes = per_source(logs, window, wide_sum(F.col("bytes_transferred")).alias("total_bytes"))
    return above(volumes, "total_bytes", threshold).select(
        "source_ip",
        "window_start",
        "total_bytes",
        capped_score(F.col("total_bytes"), rules.EXFIL_SCALE).alias("threat_score"),
        stamp(as_of).alias("detected_at"),
    )


def ip_scores(logs: DataFrame, window: str = rules.SCORE_WINDOW) -> DataFrame:
    """Mean label weight per source and window. The window stays in the result as part of its key."""
    scores = per_source(
        logs,
        window,
        mean_weight(F.col("threat_label")).alias("threat_score"),
        F.count(F.lit(1)).cast("int").alias("attack_count"),
        F.max("event_time").alias("last_seen"),
    )
    return scores.select(
        "source_ip",
        "window_start",
        "threat_score",
        "attack_count",
        "last_seen",
        is_blocked(F.col("threat_score")).alias("is_blocked"),
    )


def detect_signatures(
    logs: DataFrame, patterns: Sequence[str] = rules.SIGNATURES, as_of: AsOf = None
) -> DataFrame:
    """Rows that carry an attack signature, with its type; stateless."""
    return signature_rows(logs, patterns).select(
        "source_ip",
        "event_time",
        "dest_ip",
        "protocol",
        "action",
        "threat_label",
        "log_type",
        F.col("bytes_transferred").alias("bytes_xfer"),
        "user_agent",
        "request_path",
        signature_type().alias("attack_type"),
        F.lit(rules.SIGNATURE_SCORE).cast("float").alias("threat_score"),
        stamp(as_of).alias("window_start"),
        stamp(as_of).alias("window_end"),
    )
