"""Scores, weights and the decisions taken on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from netwatch import rules


def threat_ratio(threats: Column, requests: Column) -> Column:
    """Share of requests that were threats, as DOUBLE."""
    return threats / requests


def risk_level(score: Column, threshold: float = rules.HIGH_RISK) -> Column:
    return F.when(score > threshold, "HIGH").otherwise("LOW")


def capped_score(amount: Column, scale: float) -> Column:
    """``amount / scale`` up to 1. The quotient passes through FLOAT, the result is DOUBLE."""
    return F.least(F.lit(1.0), (amount / scale).cast("float"))


def wide_sum(amounts: Column) -> Column:
    """Aggregate: the sum as BIGINT, which stays at the ends of BIGINT instead of raising beyond them.

    Without amounts it is NULL.
    """
    most, least = 2**63 - 1, -(2**63)
    exact = F.sum(amounts.cast("decimal(19,0)"))
    return F.when(exact > most, F.lit(most)).when(exact < least, F.lit(least)).otherwise(exact.cast("bigint"))


def label_tenths(label: Column) -> Column:
    """Label weight in tenths, as INT: sums of these are exact in any order."""
    weight = F.lit(rules.OTHER_TENTHS)
    for name, tenths in rules.LABEL_TENTHS.items():
        weight = F.when(label == name, tenths).otherwise(weight)
    return weight


def label_weight(label: Column) -> Column:
    return label_tenths(label) / 10.0


def mean_weight(label: Column) -> Column:
    """Aggregate: the mean label weight as FLOAT, equal for every order of the rows."""
    return (F.sum(label_tenths(label)) / (F.count(F.lit(1)) * 10.0)).cast("float")


def is_blocked(score: Column, threshold: float = rules.HIGH_RISK) -> Column:
    """True above the threshold; a NULL score is not blocked."""
    return F.coalesce(score > threshold, F.lit(False))
