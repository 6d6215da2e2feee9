"""Rows shaped for stores: wide-column cells and time-series points."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netwatch.functions.text import plain_text
from netwatch.functions.times import stamp


def to_cells(df: DataFrame, row_key: str, family: str, col_map: Mapping[str, str]) -> DataFrame:
    """One row per non-NULL cell: ``row_key, family, qualifier, value``.

    ``col_map`` maps columns to qualifiers. A row without any cell leaves nothing, and so does a row
    without a key, which no store could address.
    """
    types = {field.name: field.dataType for field in df.schema}
    pairs: list[Column] = []
    for column, qualifier in col_map.items():
        pairs += [F.lit(qualifier), plain_text(F.col(column), types[column])]
    cells = df.filter(F.col(row_key).isNotNull()).select(
        F.col(row_key).cast("string").alias("row_key"),
        F.lit(family).alias("family"),
        F.stack(F.lit(len(col_map)), *pairs).alias("qualifier", "value"),
    )
    return cells.filter(F.col("value").isNotNull())


def to_points(
    df: DataFrame,
    measurement: str,
    tags: Sequence[str],
    fields: Sequence[str],
    time_col: str | None,
    as_of: dt.datetime | str | None = None,
) -> DataFrame:
    """One point per row: ``measurement, tags, longs, doubles, bools, strings, time``.

    Tags are text. Fields keep integer, floating and boolean types, all others become text. NULL
    tags and fields are left out; a NULL time, or that of a frame without one, becomes ``as_of``, by default the
    time of the query.
    """
    types = {field.name: field.dataType for field in df.schema}
    groups: dict[str, list[str]] = {"bigint": [], "double": [], "boolean": [], "string": []}
    for name in fields:
        groups[_field_kind(types[name])].append(name)
    return df.select(
        F.lit(measurement).alias("measurement"),
        _value_map(tags, types, "string").alias("tags"),
        _value_map(groups["bigint"], types, "bigint").alias("longs"),
        _value_map(groups["double"], types, "double").alias("doubles"),
        _value_map(groups["boolean"], types, "boolean").alias("bools"),
        _value_map(groups["string"], types, "string").alias("strings"),
        (F.coalesce(F.col(time_col).cast("timestamp"), stamp(as_of)) if time_col else stamp(as_of)).alias("time"),
    )


def _field_kind(data_type: T.DataType) -> str:
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, T.IntegralType):
        return "bigint"
    if isinstance(data_type, T.FractionalType) and not isinstance(data_type, T.DecimalType):
        return "double"
    return "string"


def _value_map(names: Sequence[str], types: Mapping[str, T.DataType], kind: str) -> Column:
    """Map of the named columns to their values, without NULLs."""
    if not names:
        return F.create_map().cast(f"map<string,{kind}>")
    values = [
        plain_text(F.col(n), types[n]) if kind == "string" else F.col(n).cast(kind) for n in names
    ]
    whole = F.map_from_arrays(F.array(*(F.lit(n) for n in names)), F.array(*values))
    return F.map_filter(whole, lambda _, value: value.isNotNull())
