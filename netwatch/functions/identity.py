"""Hashes that stand for a whole row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATS = (T.FloatType, T.DoubleType)
NESTED = (T.ArrayType, T.MapType, T.StructType)


def row_hash(df: DataFrame, columns: list[str], seed: int = 42) -> Column:
    """A hash of the named columns that keeps apart rows which Spark's own hash takes for equal.

    That hash passes over NULLs, so that a value and a NULL that change places hash alike, and takes both
    signed zeros for one number. Here each column is hashed with whether it is NULL, floats and nested
    values as text.
    """
    parts: list[Column] = []
    for name in columns:
        kind, value = df.schema[name].dataType, F.col(name)
        if isinstance(kind, FLOATS):
            value = value.cast("string")
        elif isinstance(kind, NESTED):
            value = F.to_json(F.struct(value), {"ignoreNullFields": "false"})
        parts += [F.col(name).isNull(), value]
    return F.xxhash64(F.lit(seed), *parts)
