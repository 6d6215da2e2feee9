"""Days of a log: the latest, the list, and the count."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netwatch.functions.times import event_day
from netwatch.schema import DAY_PARTS


def max_day(logs: DataFrame) -> DataFrame:
    """One row with the latest event day, NULL when there is none."""
    return logs.agg(F.max(event_day(F.col("event_time"))).alias("max_day"))


def is_empty(df: DataFrame) -> bool:
    """True without rows; stops at the first row found instead of counting all."""
    return df.isEmpty()


def day_summary(logs: DataFrame) -> DataFrame:
    """Events per day; events without a readable time are counted under NULL."""
    return logs.groupBy(event_day(F.col("event_time")).alias("day")).agg(
        F.count(F.lit(1)).alias("event_count")
    )


def day_count(logs: DataFrame) -> DataFrame:
    """One row with the number of different days."""
    return day_summary(logs).agg(F.count("day").alias("day_count"))


def list_days(df: DataFrame) -> DataFrame:
    """The days present, ascending, as integers ``year, month, day``.

    They come from the day folder columns where the frame has them, otherwise from the event time.
    """
    if not all(part in df.columns for part in DAY_PARTS):
        time = F.col("event_time")
        df = df.select(F.year(time).alias("year"), F.month(time).alias("month"), F.day(time).alias("day"))
    days = df.select(*(F.col(part).cast("int").alias(part) for part in DAY_PARTS))
    return days.dropna().distinct().orderBy(*DAY_PARTS)


def days_after(days: DataFrame, marker: str | dt.date | None) -> DataFrame:
    """The listed days later than the marker, by value; all of them without a marker."""
    dated = days.select(F.make_date(*DAY_PARTS).alias("day"))
    if marker is not None:
        dated = dated.filter(F.col("day") > F.lit(str(marker)).cast("date"))
    return dated.orderBy("day")
