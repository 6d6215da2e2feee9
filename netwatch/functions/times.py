"""Timestamps, dates and processing stamps."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how a day is spelled in a folder path.
DAY_FOLDER = r"year=(\d{4})/month=(\d{1,2})/day=(\d{1,2})"
# How a time that names its day begins.
WHOLE_DATE = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"


def parse_time(text: Column, fmt: str | None = None, default: dt.datetime | None = None) -> Column:
    """Text to TIMESTAMP. Unreadable text gives NULL, or ``default`` where one is given.

    Without ``fmt`` the text is cast, which reads both spellings of the log, ``2024-01-05T10:00:00``
    and ``2024-01-05 10:00:00``, each with an optional fraction, and costs far less than a format. Text
    must begin with a whole date: a cast alone would read ``10:00:00`` as a time of today.
    """
    if fmt:
        time = F.try_to_timestamp(text, F.lit(fmt))
    else:
        time = F.when(text.cast("string").rlike(WHOLE_DATE), text.try_cast("timestamp"))
    return time if default is None else F.coalesce(time, F.lit(default).cast("timestamp"))


def time_text(time: Column) -> Column:
    """TIMESTAMP to ISO text; the fraction is written only where there is one."""
    return F.replace(time.cast("string"), F.lit(" "), F.lit("T"))


def event_day(time: Column) -> Column:
    """The calendar day of an event (detection date and partition date)."""
    return F.to_date(time)


def hour_bucket(time: Column) -> Column:
    return F.date_trunc("hour", time)


def lit_day(day: str | dt.date) -> Column:
    """A day as the TIMESTAMP of its first instant."""
    return F.lit(str(day)).cast("date").cast("timestamp")


def stamp(as_of: dt.datetime | str | None = None) -> Column:
    """Processing time: the clock of the query, or ``as_of`` for repeatable runs."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def folder_date(year: Column, month: Column, day: Column) -> Column:
    """The DATE of a day folder, from its three folder columns (text or number)."""
    return F.make_date(year.cast("int"), month.cast("int"), day.cast("int"))


def day_from_path(path: Column | None = None) -> Column:
    """The DATE in a path such as ``.../year=2024/month=01/day=05/...``, NULL without one.

    By default the path is that of the file each row was read from.
    """
    path = F.input_file_name() if path is None else path
    year, month, day = (F.regexp_extract(path, DAY_FOLDER, n) for n in (1, 2, 3))
    text = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return text.try_cast("date")


def day_of_folder(path: str) -> str | None:
    """The same for one path on the driver, as ``yyyy-MM-dd``."""
    found = re.search(DAY_FOLDER, path)
    return "{}-{:0>2}-{:0>2}".format(*found.groups()) if found else None
