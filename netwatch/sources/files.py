"""Folders, on whatever file system Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Fixed value: the file that Spark leaves in a folder once all of it is written.
DONE = "_SUCCESS"


def _located(spark: SparkSession, path: str):
    located = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), located


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, in order; none when there is no such folder."""
    system, path = _located(spark, folder)
    if not system.exists(path):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(path))


def remove(spark: SparkSession, path: str) -> None:
    """Removes a file or a folder with all in it; nothing happens when it is gone already."""
    system, located = _located(spark, path)
    system.delete(located, True)


def written_parts(spark: SparkSession, folder: str, column: str) -> list[str]:
    """The values of the folders ``column=value`` that were written to their end."""
    sign = f"{column}="
    parts = [name.removeprefix(sign) for name in names_in(spark, folder) if name.startswith(sign)]
    return [part for part in parts if DONE in names_in(spark, f"{folder}/{sign}{part}")]
