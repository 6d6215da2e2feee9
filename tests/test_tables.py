"""Tables under generations: nothing is lost at any step, folded folders go, days expire as folders, versions are kept."""

import datetime as dt
import os

import pytest

from netwatch.operators import views
from netwatch.schema import TYPED_SCHEMA
from netwatch.sources.files import names_in
from netwatch.streaming import tables
from netwatch.streaming.runs import TABLE_KEYS, alert_table
from netwatch.streaming.tables import KeyedTable
from tests.helpers import values

SCHEMA = "k string, v int, t timestamp"


def batch(spark, number, keys="abc"):
    return spark.createDataFrame([(k, number, dt.datetime(2024, 1, 1 + number, 5)) for k in keys], SCHEMA)


def files(folder):
    return {os.path.join(at, name): os.stat(os.path.join(at, name)).st_mtime_ns for at, _, names in os.walk(folder) for name in names}


def test_levels_hold_the_table_and_folded_folders_go(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["k"], fan_in=2, kept_generations=0)
    for number in range(8):
        table.write(batch(spark, number, "abc"[: 1 + number % 3]), number)
        if number % 2:
            table.compact(number)
        assert values(table.rows(), "k", "v") == sorted(
            (k, max(n for n in range(number + 1) if n % 3 >= i)) for i, k in enumerate("abc") if number >= i
        )
    assert names_in(spark, f"{folder}/t/batches") == []
    live = table.generation()
    assert live.upto == 7 and len(live.runs) == 1 and live.runs[0][1] > 1
    assert names_in(spark, f"{folder}/t/runs") == [f"run={live.runs[0][0]}"]
    before = files(f"{folder}/t")
    table.compact(7)
    assert files(f"{folder}/t") == before


@pytest.mark.parametrize("step", ["_save", "_commit", "clean"])
def test_a_compaction_that_breaks_off_loses_nothing(spark, folder, monkeypatch, step):
    table = KeyedTable(spark, f"{folder}/t", ["k"], fan_in=2, kept_generations=0)
    for number in range(4):
        table.write(batch(spark, number, "abcd"[number:]), number)
    table.compact(1)
    expected = values(table.rows())
    whole = getattr(KeyedTable, step)

    def broken(self, *args):
        if step == "_save":  # the run is there, but nothing names it
            whole(self, *args)
        raise OSError("lost the driver")

    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, step, broken)
        with pytest.raises(OSError):
            table.compact(3)
    assert values(table.rows()) == expected
    table.compact(3)
    assert values(table.rows()) == expected
    assert names_in(spark, f"{folder}/t/batches") == [] and len(names_in(spark, f"{folder}/t/runs")) == 1


def test_a_removal_that_breaks_off_is_taken_up_again(spark, folder, monkeypatch):
    table = KeyedTable(spark, f"{folder}/t", ["k"], kept_generations=0)
    for number in range(4):
        table.write(batch(spark, number), number)
    expected, removed = values(table.rows()), []

    def once(session, path):
        if removed:
            raise OSError("lost the driver")
        removed.append(path)
        whole(session, path)

    whole = tables.remove
    with monkeypatch.context() as patch:
        patch.setattr(tables, "remove", once)
        with pytest.raises(OSError):
            table.compact(3)
    assert removed and values(table.rows()) == expected
    table.clean()
    assert names_in(spark, f"{folder}/t/batches") == [] and values(table.rows()) == expected


def test_a_reader_of_the_generation_before_ends_undisturbed(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["k"], fan_in=2)
    for number in range(2):
        table.write(batch(spark, number), number)
    table.compact(0)
    reading = table.rows()
    expected = values(table.rows())
    table.compact(1)
    assert values(reading) == expected == values(table.rows())


def test_an_unfinished_batch_is_not_read(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["k"])
    table.write(batch(spark, 0), 0)
    table.write(batch(spark, 1), 1)
    os.remove(f"{folder}/t/batches/batch=1/_SUCCESS")
    assert {v for _, v in values(table.rows(), "k", "v")} == {0}


def test_tables_can_be_read_before_the_first_batch(spark, folder):
    for name in TABLE_KEYS:
        table = alert_table(spark, folder, name)
        assert table.rows().count() == 0 and "source_ip" in table.rows().columns
    with pytest.raises(ValueError):
        tables.read_latest(spark, f"{folder}/none", ["k"])
    assert spark.createDataFrame([], TYPED_SCHEMA).columns[0] == "event_time"


def test_days_expire_as_folders_and_no_file_is_written(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", written_at="t", ttl_seconds=86_400)
    for number in range(6):
        table.write(batch(spark, number, "aab").unionByName(spark.createDataFrame([("n", number, None)], SCHEMA)), number)
    table.compact(2)
    before = files(f"{folder}/t/runs") | files(f"{folder}/t/batches")
    as_of = dt.datetime(2024, 1, 4, 5)  # alive: written after the 3rd, 05:00
    alive = values(table.rows(as_of=as_of), "k", "v")
    gone = table.drop_expired(as_of)
    assert gone and all(day[-2:] in ("01", "02") for day in gone)
    after = files(f"{folder}/t/runs") | files(f"{folder}/t/batches")
    assert after.items() < before.items()
    assert alive == values(table.rows(as_of=as_of), "k", "v") == sorted([(k, n) for n in (3, 4, 5) for k in "aab"])
    table.drop_expired(dt.datetime(2024, 3, 1))
    assert {k for k, _ in values(table.rows(), "k", "v")} == {"n"}
    with pytest.raises(ValueError):
        KeyedTable(spark, f"{folder}/t", ttl_seconds=1)


def test_pruning_leaves_dead_days_unread(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", written_at="t", ttl_seconds=86_400)
    table.write(batch(spark, 0).unionByName(batch(spark, 4)), 0)
    plan = table.rows(as_of="2024-01-05 06:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_written_on" in plan


def test_versions_are_kept_level_by_level(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["k"], versions=3, fan_in=2, kept_generations=0)
    for number in range(7):
        table.write(batch(spark, number, "ab" if number < 5 else "a"), number)
        table.compact(number)
    assert values(table.rows(), "k", "version", "v") == [
        ("a", 1, 6), ("a", 2, 5), ("a", 3, 4), ("b", 1, 4), ("b", 2, 3), ("b", 3, 2),
    ]
    stored = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/t/runs")
    assert stored.groupBy("k").count().filter("count > 3").isEmpty() or len(table.generation().runs) > 1


def test_port_bitmaps_count_exactly(spark):
    ports = [0, 1, 32_767, 32_768, 65_534, 65_535, 65_536, 7, 7]
    rows = spark.createDataFrame([(p,) for p in ports], "p int").filter("p <= 65535")
    assert rows.agg(views._bits_set("p")).first()[0] == 7
    assert rows.filter("p > 70000").agg(views._bits_set("p")).first()[0] == 0
