"""CSV logs: one day folder, all day folders, and the raw zone."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netwatch.functions.times import day_from_path
from netwatch.operators.enrich import typed_logs
from netwatch.schema import DAY_PARTS

# Quotes inside quoted text are doubled. Headers are compared with the schema for each file, so a file
# with another column order is refused instead of being read into the wrong columns.
CSV_OPTIONS = {"header": "true", "escape": '"', "enforceSchema": "false"}

GLOB_SIGNS = re.compile(r"[*?\[{]")


def read_raw(spark: SparkSession, path: str, infer: bool = True) -> DataFrame:
    """The CSV as it is, with inferred types (one more pass over the data) or all text."""
    return spark.read.options(**CSV_OPTIONS).option("inferSchema", infer).csv(path)


def read_text_logs(spark: SparkSession, path: str) -> DataFrame:
    """All-text record. A base folder, or a glob below it, adds ``year, month, day``."""
    reader = spark.read.options(**CSV_OPTIONS)
    base = glob_base(path)
    if base:
        reader = reader.option("basePath", base)
    return reader.csv(path)


def read_logs(
    spark: SparkSession, path: str, default_time: dt.datetime | None = None
) -> DataFrame:
    """Typed record of all day folders below ``path`` (a folder or a glob), bound by name."""
    return typed_logs(read_text_logs(spark, path), default_time=default_time)


def read_day(
    spark: SparkSession, path: str, default_time: dt.datetime | None = None
) -> DataFrame:
    """Typed record of one day folder."""
    return typed_logs(read_raw(spark, path, infer=False), default_time=default_time)


def glob_base(path: str) -> str | None:
    """The part of a glob above its first wildcard; None for a plain path."""
    sign = GLOB_SIGNS.search(path)
    return path[: sign.start()].rpartition("/")[0] if sign else None


def read_folders(spark: SparkSession, base: str, folders: list[str]) -> DataFrame:
    """Typed record of some day folders below ``base``, with their ``year, month, day``."""
    return typed_logs(spark.read.options(**CSV_OPTIONS).option("basePath", base).csv(folders))


def stored_files(spark: SparkSession, base: str) -> DataFrame:
    """``path, length, modified`` and the day ``folder`` of the files in day folders, from the file listing.

    ``base`` is a folder of day folders, or one of these. No log file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    listed = files.select("path", "length", F.col("modificationTime").alias("modified"))
    return listed.withColumn("folder", day_from_path(F.col("path"))).filter(F.col("folder").isNotNull())


def stored_days(spark: SparkSession, base: str) -> DataFrame:
    """The day folders that hold files, from the file listing: no log file is opened."""
    files = spark.read.format("binaryFile").load(base)
    return files.select(*DAY_PARTS)
