"""High-water marks and day markers: one line of text in a folder."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def read_hwm(spark: SparkSession, path: str) -> str | None:
    """The mark, or None when none was ever written. Any other failure is raised."""
    try:
        row = spark.read.text(path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row.value if row else None


def write_hwm(spark: SparkSession, path: str, value: str | dt.date) -> None:
    """Replaces the mark: one row, hence one file."""
    line = spark.range(0, 1, 1, 1).select(F.lit(str(value)).alias("value"))
    line.write.mode("overwrite").text(path)
