"""Keys, ports, numbers in text, and values as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The port at the end of host:port, and the separator inside a row key.
PORT = r":(\d+)"
KEY_SEPARATOR = "#"


def row_key(*columns: Column) -> Column:
    """Composite key text; NULL parts are skipped together with their separator."""
    return F.concat_ws(KEY_SEPARATOR, *(c.cast("string") for c in columns))


def dest_port(address: Column, null_as: str | None = None) -> Column:
    """Port text of ``host:port``: ``''`` without a port, ``null_as`` for a NULL address."""
    port = F.regexp_extract(address, PORT, 1)
    return port if null_as is None else F.coalesce(port, F.lit(null_as))


def filled(text: Column) -> Column:
    """The text, or NULL where it is empty.

    Use it before ``try_cast``: a NULL passes through, while text that does not convert costs an
    exception per row.
    """
    return F.nullif(text, F.lit(""))


def bytes_number(text: Column) -> Column:
    """Bytes text to BIGINT; unreadable text gives NULL."""
    return filled(F.trim(text)).try_cast("bigint")


def port_number(address: Column) -> Column:
    """Port of ``host:port`` as INT, NULL without a valid one."""
    number = filled(dest_port(address)).try_cast("int")
    return F.when(number.between(0, 65_535), number)


def plain_text(value: Column, data_type: T.DataType) -> Column:
    """The value as the stores hold it, that is spelled the way Python's ``str`` spells it."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return _double_text(value.cast("double"))
    if isinstance(data_type, T.BooleanType):
        return F.initcap(value.cast("string"))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_trunc("second", value.cast("timestamp")) == value.cast("timestamp")
        return F.when(whole, F.date_format(value, "yyyy-MM-dd HH:mm:ss")).otherwise(
            F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        )
    return value.cast("string")


def _double_text(x: Column) -> Column:
    """Shortest text that reads back as ``x``, positional from 1e-4 up to 1e16.

    Spark's own cast turns to E-notation from 1e7 on, and on older Java versions it does not always
    find the shortest digits, so the digits are taken from the 16-digit form where that reads back.
    """
    size = F.abs(x)
    # NULL, NaN and infinity have no digits: the formatter would spell them out.
    finite = F.when(size < float("inf"), size)
    short = F.when(finite.isNotNull(), F.format_string("%.15e", finite))
    digits = F.when(short.cast("double") == size, short).otherwise(F.format_string("%.16e", finite))
    fixed = digits.try_cast("decimal(38,21)").cast("string")
    text = (
        F.when(size == 0, "0.0")
        .when((size >= 1e-4) & (size < 1e16), F.regexp_replace(fixed, r"(\.\d+?)0*$", "$1"))
        .when(finite.isNotNull(), F.regexp_replace(digits, r"\.?0*e", "e"))
        .when(F.isnan(x), "nan")
        .when(size.isNotNull(), "inf")
    )
    return F.when(x < 0, F.concat(F.lit("-"), text)).otherwise(text)
