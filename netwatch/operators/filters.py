"""Row filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netwatch import rules
from netwatch.functions.times import event_day, folder_date, parse_time
from netwatch.schema import DAY_PARTS


def attacks_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("attack_type") != rules.NO_ATTACK)


def threats_only(df: DataFrame, labels: Sequence[str] = rules.THREAT_LABELS) -> DataFrame:
    return df.filter(F.col("threat_label").isin(*labels))


def failed_access(
    df: DataFrame, refused: str = rules.REFUSED_ACTION, mark: str = rules.LOGIN_MARK
) -> DataFrame:
    """Requests with the refused action, and requests to any path that contains the login mark in any case."""
    to_login = F.contains(F.lower("request_path"), F.lit(mark))
    return df.filter((F.col("action") == refused) | to_login)


def signature_rows(df: DataFrame, patterns: Sequence[str] = rules.SIGNATURES) -> DataFrame:
    """Rows whose path or agent matches any of the patterns, with case."""
    path, agent = (F.col(name).rlike("|".join(patterns)) for name in ("request_path", "user_agent"))
    return df.filter(path | agent)


def at_least(df: DataFrame, column: str, n: float) -> DataFrame:
    return df.filter(F.col(column) >= n)


def above(df: DataFrame, column: str, n: float) -> DataFrame:
    return df.filter(F.col(column) > n)


def after_mark(df: DataFrame, mark: str | dt.date | None) -> DataFrame:
    """Events of days after the mark; all events when there is no mark.

    Where the frame carries the day folder columns, its days are those of the folders: files of older
    days are not read, and a row whose own time is missing or wrong counts with its folder, in one run
    as in several. Without them the day is that of the event, and rows without a time are of no day.
    """
    if mark is None:
        return df
    limit = F.lit(str(mark)).cast("date")
    if all(part in df.columns for part in DAY_PARTS):
        return df.filter(folder_date(*(F.col(part) for part in DAY_PARTS)) > limit)
    return df.filter(event_day(F.col("event_time")) > limit)


def valid_days(raw: DataFrame, column: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """Splits text records into those whose time names a valid day, and the rejected rest."""
    dated = parse_time(F.col(column)).isNotNull()
    return raw.filter(dated), raw.filter(~dated)
