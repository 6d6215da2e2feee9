"""The serving view over the batch and the speed layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netwatch import rules
from netwatch.functions.scores import is_blocked
from netwatch.operators.keyed import latest_per_key


def latest_scores(scores: DataFrame) -> DataFrame:
    """The live score of each source: that of its latest window."""
    return latest_per_key(scores, ["source_ip"], ["window_start"])


def serving_ip_risk(batch: DataFrame, speed: DataFrame) -> DataFrame:
    """One row per source known to either layer; the combined score is the greater of the two.

    ``batch`` is a reputation view and ``speed`` holds one live score per source. Both have one row
    per source, so they are put one below the other and meet in a group of two; sources without an
    address are a group too. A join that lets them match would hash both sides by another key.
    """
    live = F.col("threat_score").cast("double")
    both = batch.select("source_ip", "total_requests", F.col("threat_score").alias("batch_score")).unionByName(
        speed.select("source_ip", live.alias("live_score"), "last_seen"), allowMissingColumns=True
    )
    measures = ("total_requests", "batch_score", "live_score", "last_seen")
    joined = both.groupBy("source_ip").agg(*(F.max(name).alias(name) for name in measures))
    combined = F.greatest("batch_score", "live_score")
    return joined.select(
        "source_ip",
        *measures,
        combined.alias("risk_score"),
        is_blocked(combined, rules.HIGH_RISK).alias("is_blocked"),
    )
