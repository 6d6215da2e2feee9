"""Keyed-store behaviour on frames: upsert, versions, expiry, clustering."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` values of each key; the other columns settle equal ones.

    A maximum of structs is combined on the map side: one row per key and task is shuffled.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return newest.select(*(c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns))


def upsert_latest(
    current: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """The table after the batch has been written: the last write of each key wins.

    Writes are ordered by ``order``, and for equal values the batch comes after the current rows.
    """
    both = current.withColumn("_write", F.lit(0)).unionByName(batch.withColumn("_write", F.lit(1)))
    return latest_per_key(both, keys, [*order, "_write"]).drop("_write")


def keep_versions(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The n rows of each key with the greatest ``order`` values; ``version`` 1 is the newest.

    Spark cuts each map task to n rows per key before the shuffle as long as n is at most
    ``spark.sql.optimizer.windowGroupLimitThreshold``. Beyond that a first ranking inside shares of
    each key does the same, so that a hot key never meets in one task as a whole. Shares go by the task
    that read a row, as exact copies of a row would share any value computed from it. Rows of equal
    ``order`` are taken by their other columns, so that the same rows stay whatever the layout.
    """
    settled = [c for c in df.columns if c not in keys and c not in order]
    newest_first = [F.desc(c) for c in [*order, *settled]]
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n > limit:
        share = F.spark_partition_id()
        per_share = Window.partitionBy(*keys, "_share").orderBy(*newest_first)
        df = (
            df.withColumn("_share", share)
            .withColumn("_rank", F.row_number().over(per_share))
            .filter(F.col("_rank") <= n)
            .drop("_share", "_rank")
        )
    per_key = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("version", F.row_number().over(per_key)).filter(F.col("version") <= n)


def expire(df: DataFrame, written_at: str, ttl_seconds: int, as_of: dt.datetime | str) -> DataFrame:
    """Rows that are still alive at ``as_of``: written less than ``ttl_seconds`` before it."""
    oldest = F.lit(as_of).cast("timestamp") - F.make_dt_interval(secs=F.lit(ttl_seconds))
    return df.filter(F.col(written_at) > oldest)


def clustered(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Rows laid out by key, and inside a key by ``order``.

    Ranges are cut over key and order together: a hot key spans several neighbouring partitions
    instead of filling one, and reading the partitions in turn gives the whole clustering order.
    Rows that are equal in both are spread by the task that read them, which is the same for a task
    that runs again, so copies of one row do not meet in one partition either.
    """
    layout = [F.col(key), *order]
    read_by = df.withColumn("_task", F.spark_partition_id())
    placed = read_by.repartitionByRange(*layout, "_task").sortWithinPartitions(*layout)
    return placed.drop("_task")
