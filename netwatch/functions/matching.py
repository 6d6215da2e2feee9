"""Regex rules on columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from netwatch import rules


def rule_flags(text: Column, rule_set: Mapping[str, str]) -> list[Column]:
    """One 0/1 column per rule, named after it. NULL text gives 0."""
    return [F.when(text.rlike(p), 1).otherwise(0).alias(name) for name, p in rule_set.items()]


def attack_type(text: Column, rule_set: Mapping[str, str]) -> Column:
    """Name of the first matching rule. Later patterns are not tried once one has matched."""
    return first_match(((name, text, p) for name, p in rule_set.items()), rules.NO_ATTACK)


def signature_type() -> Column:
    """Type of a row that is already known to carry a signature."""
    candidates = ((name, F.col(column), p) for name, column, p in rules.SIGNATURE_TYPES)
    return first_match(candidates, rules.OTHER_SIGNATURE)


def first_match(candidates: Iterable[tuple[str, Column, str]], default: str) -> Column:
    decision = F
    for name, text, pattern in candidates:
        decision = decision.when(text.rlike(pattern), name)
    return decision.otherwise(default)
