"""Batch runs over new, changed and late files.

    counts/run=<n>/folder=<day>/view=<v>    raw counts of all views for the day folders that a run counted
    ledger/run=<n>                          the files that are counted, and the run that holds their folder's counts
    mark, kind                              the last day folder counted; which of the two runs keeps this state

A run compares the listing of the log with the files of the last ledger by path, length and time. Each day folder that has
new, changed or missing files is counted anew as a whole, in one pass over all of them, and the next ledger puts these counts in
place of the folder's earlier ones. So late files, replaced files and files that went away give what one run over
everything gives, and so do rows whose own time is missing or far off, as a row counts with its folder. The ledger is written
last and read only when complete: a run that fails before that leaves the state as it was.
Totals and ratios are made when a view is read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netwatch import rules
from netwatch.functions.scores import wide_sum
from netwatch.functions.text import row_key
from netwatch.functions.times import day_of_folder, folder_date
from netwatch.operators.days import days_after, list_days
from netwatch.operators.filters import attacks_only
from netwatch.operators.views import VIEW_NUMBERS, count_views, rate_reputation
from netwatch.schema import DAY_PARTS
from netwatch.sources.files import names_in, remove, written_parts
from netwatch.sources.logs import read_day, read_folders, stored_days, stored_files
from netwatch.sources.marks import read_hwm, write_hwm

# The stored counts and the ledger. The columns are given on reading, as a view may still be empty.
COUNTS = (
    "source_ip string, attack_type string, detection_date date, hour timestamp, threat_label string, "
    "events bigint, threats bigint, bytes bigint, processed_at timestamp, run bigint, folder date, view int"
)
LEDGER = "path string, length bigint, modified timestamp, folder date, run bigint"


def run_incremental(
    spark: SparkSession,
    base: str,
    state: str,
    rule_set: Mapping[str, str] = rules.BATCH_B,
    as_of: dt.datetime | str | None = None,
    partitions: int | None = None,
) -> str | None:
    """Brings the views up to the files that are there now, and returns the mark: the last day folder counted.

    Without a change nothing is read. ``partitions`` redistributes the input evenly, for sources that
    come as a few unsplittable files.
    """
    _claim(spark, state, "incremental")
    number, ledger = _ledger(spark, state)
    listed = stored_files(spark, base) if names_in(spark, base) else spark.createDataFrame([], LEDGER).drop("run")
    known = ledger.drop("run")
    changed = listed.exceptAll(known).unionByName(known.exceptAll(listed)).select("folder").distinct()
    days = [row.folder for row in changed.collect()]  # one row per changed day
    if days:
        changes = F.col("folder").isin(days)
        # A folder's path is that of its files; the listing may spell days with one digit or two.
        folders = listed.filter(changes).select(F.regexp_replace("path", "/[^/]*$", "").alias("at")).distinct()
        paths = [row.at for row in folders.collect()]
        if paths:
            logs = read_folders(spark, base, paths).withColumn("folder", folder_date(*(F.col(p) for p in DAY_PARTS)))
            if partitions:
                logs = logs.repartition(partitions)
            _save_counts(count_views(logs, rule_set, as_of, by=["folder"]), state, number + 1)
        _commit(ledger, listed, days, state, number + 1)
        _clean(spark, state)
    newest = _ledger(spark, state)[1].agg(F.max("folder")).first()[0]
    if newest is None:
        return None
    write_hwm(spark, f"{state}/mark", newest)
    return str(newest)


def pending_days(spark: SparkSession, base: str, marker: str | dt.date | None) -> DataFrame:
    """Day folders after the marker, ascending; all of them without a marker."""
    return days_after(list_days(stored_days(spark, base)), marker)


def run_days(
    spark: SparkSession,
    base: str,
    state: str,
    process: Callable[[SparkSession, str, str], None] | None = None,
) -> list[str]:
    """Processes the pending days one after the other and returns those done.

    A state that incremental runs keep is refused.

    The marker moves after each day. A failure is raised and leaves the marker on the last good day,
    so that the next run goes on from there. ``process`` is given the session, the folder of the
    day and the state folder.
    """
    _claim(spark, state, "days")
    process = process or add_day
    pending = pending_days(spark, base, read_hwm(spark, f"{state}/mark")).collect()
    done = []
    for row in pending:
        process(spark, f"{base}/{row.day:year=%Y/month=%m/day=%d}", state)
        write_hwm(spark, f"{state}/mark", row.day)
        done.append(str(row.day))
    return done


def add_day(spark: SparkSession, folder: str, state: str) -> None:
    """Adds the views of one day folder under the first rule set."""
    day = day_of_folder(folder)
    if day is None:
        raise ValueError(f"not a day folder: {folder}")
    _claim(spark, state, "days")
    number, ledger = _ledger(spark, state)
    as_date = dt.date.fromisoformat(day)
    logs = read_day(spark, folder).withColumn("folder", F.lit(as_date))
    _save_counts(count_views(logs, rules.BATCH_A, by=["folder"]), state, number + 1)
    _commit(ledger, stored_files(spark, folder), [as_date], state, number + 1)
    _clean(spark, state)


def merged_reputation(spark: SparkSession, state: str) -> DataFrame:
    """Reputation over all increments: counts are added up, ratios are made from the sums."""
    totals = _stored(spark, state, "ip_reputation").groupBy("source_ip")
    counts = totals.agg(
        F.sum("events").alias("total_requests"), F.sum("threats").alias("threat_count")
    )
    return rate_reputation(counts)


def daily_reputation(spark: SparkSession, state: str) -> DataFrame:
    """Reputation of each day on its own, from a state that ``run_days`` keeps."""
    counts = _stored(spark, state, "ip_reputation").select(
        "source_ip",
        F.col("events").alias("total_requests"),
        F.col("threats").alias("threat_count"),
        F.col("folder").cast("timestamp").alias("detection_date"),
    )
    return rate_reputation(counts)


def merged_patterns(spark: SparkSession, state: str) -> DataFrame:
    found = attacks_only(_stored(spark, state, "attack_patterns"))
    merged = found.groupBy("attack_type", "detection_date").agg(
        F.sum("events").alias("attack_count"), F.max("processed_at").alias("last_seen")
    )
    return merged.withColumn("row_key", row_key(F.col("attack_type"), F.col("detection_date")))


def merged_timeline(spark: SparkSession, state: str) -> DataFrame:
    merged = (
        _stored(spark, state, "threat_timeline")
        .groupBy("hour", "threat_label")
        .agg(
            F.sum("events").alias("event_count"),
            wide_sum(F.col("bytes")).cast("double").alias("total_bytes"),
        )
    )
    return merged.withColumn("row_key", row_key(F.col("threat_label"), F.col("hour")))


def _claim(spark: SparkSession, state: str, kind: str) -> None:
    """Notes the kind of run that keeps the state; the other kind counts by other rules and is refused."""
    found = read_hwm(spark, f"{state}/kind")
    if found is None:
        write_hwm(spark, f"{state}/kind", kind)
    elif found != kind:
        raise ValueError(f"{state} is kept by {found} runs, not by {kind} ones")


def _ledger(spark: SparkSession, state: str) -> tuple[int, DataFrame]:
    """The number of the last complete run, 0 without one, and its ledger."""
    numbers = [int(n) for n in written_parts(spark, f"{state}/ledger", "run")]
    if not numbers:
        return 0, spark.createDataFrame([], LEDGER)
    last = max(numbers)
    return last, spark.read.schema(LEDGER.replace(", run bigint", ", counted bigint")).parquet(f"{state}/ledger/run={last}").withColumnRenamed("counted", "run")


def _save_counts(counts: DataFrame, state: str, number: int) -> None:
    """Writes the counts of a run; small folders share a task."""
    writer = counts.hint("rebalance", "folder", "view").write.partitionBy("folder", "view")
    writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{state}/counts/run={number}")


def _commit(ledger: DataFrame, listed: DataFrame, days: list[dt.date], state: str, number: int) -> None:
    """Writes the ledger with the files of the counted days in place of those it held for these days."""
    counted = F.col("folder").isin(days)
    files = listed.filter(counted).withColumn("run", F.lit(number).cast("bigint"))
    rows = ledger.filter(~counted).unionByName(files).withColumnRenamed("run", "counted")
    rows.write.mode("overwrite").parquet(f"{state}/ledger/run={number}")


def _clean(spark: SparkSession, state: str) -> None:
    """Removes ledgers before the last two, and counts that neither of these names."""
    numbers = sorted(int(n) for n in written_parts(spark, f"{state}/ledger", "run"))
    for number in numbers[:-2]:
        remove(spark, f"{state}/ledger/run={number}")
    used = set()
    for number in numbers[-2:]:
        used |= {(r.counted, r.folder) for r in spark.read.parquet(f"{state}/ledger/run={number}").select("counted", "folder").distinct().collect()}
    for run in written_parts(spark, f"{state}/counts", "run"):
        for name in names_in(spark, f"{state}/counts/run={run}"):
            day = name.removeprefix("folder=")
            if day != name and (int(run), dt.date.fromisoformat(day)) not in used:
                remove(spark, f"{state}/counts/run={run}/{name}")


def _stored(spark: SparkSession, state: str, view: str) -> DataFrame:
    """The counts that the last ledger names."""
    _, ledger = _ledger(spark, state)
    if not names_in(spark, f"{state}/counts"):
        return spark.createDataFrame([], COUNTS)
    stored = spark.read.schema(COUNTS).parquet(f"{state}/counts").filter(F.col("view") == VIEW_NUMBERS[view])
    return stored.join(ledger.select("run", "folder").distinct(), ["run", "folder"], "left_semi")
