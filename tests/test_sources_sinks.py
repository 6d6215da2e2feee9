import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from netwatch.functions.times import day_from_path
from netwatch.operators.enrich import raw_logs
from netwatch.operators.views import threat_timeline
from netwatch.plans.publish import publish
from netwatch.schema import LOG_FIELDS
from netwatch.sinks import stores
from netwatch.sinks.days import write_by_day, write_view
from netwatch.sources.envelope import decode_envelope, encode_envelope
from netwatch.sources.logs import glob_base, read_day, read_logs, read_raw, stored_days
from netwatch.sources.marks import read_hwm, write_hwm
from tests.helpers import at, logs, raw, values


def write_csv(folder, name, lines, header=",".join(LOG_FIELDS)):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join([header, *lines]) + "\n")


LINE = "2024-01-05T10:00:00,10.0.0.1,1.2.3.4:80,HTTP,blocked,malicious,ids,15,agent,/a"


def test_ten_field_file_binds_by_name(spark, folder):
    write_csv(folder, "a.csv", [LINE, '2024-01-05 11:00:00,,"",TCP,allowed,,ids,xx,"a ""q"" b",/b'])
    first, second = read_day(spark, folder).orderBy("event_time").collect()
    assert (first.request_path, first.threat_label, first.bytes_transferred) == ("/a", "malicious", 15)
    assert (second.source_ip, second.dest_ip, second.threat_label, second.bytes_transferred) == (None,) * 4
    assert second.user_agent == 'a "q" b' and second.event_time == at("2024-01-05 11:00")


def test_extra_and_reordered_columns(spark, folder):
    header = "response_code," + ",".join(reversed(LOG_FIELDS))
    write_csv(folder, "a.csv", ["200," + ",".join(reversed(LINE.split(",")))], header)
    row = read_day(spark, folder).first()
    assert (row.request_path, row.threat_label, row.source_ip) == ("/a", "malicious", "10.0.0.1")


def test_files_with_different_column_orders_are_refused(spark, folder):
    write_csv(folder, "a.csv", [LINE])
    write_csv(folder, "b.csv", [",".join(reversed(LINE.split(",")))], ",".join(reversed(LOG_FIELDS)))
    with pytest.raises(Exception, match="(?i)header"):
        read_day(spark, folder).collect()


def test_day_folders_round_trip(spark, folder):
    rows = raw(
        spark,
        {"timestamp": "2024-01-05 10:00:00"},
        {"timestamp": "2024-01-05T10:00:00", "request_path": 'a,"b"', "source_ip": None},
        {"timestamp": "2024-11-15T00:00:00"},
        {"timestamp": "bad"},
        {"timestamp": None},
    )
    rejected = write_by_day(rows, f"{folder}/logs")
    assert values(rejected, "timestamp") == [("bad",), (None,)]
    assert os.path.isdir(f"{folder}/logs/year=2024/month=01/day=05")
    assert os.path.isdir(f"{folder}/logs/year=2024/month=11/day=15")

    back = read_logs(spark, f"{folder}/logs")
    assert values(back, "request_path", "source_ip", "year", "month", "day") == [
        ("/index.html", "10.0.0.1", 2024, 1, 5), ("/index.html", "10.0.0.1", 2024, 11, 15), ('a,"b"', None, 2024, 1, 5),
    ]
    assert values(read_logs(spark, f"{folder}/logs/*/*/*")) == values(back)
    leaf = read_day(spark, f"{folder}/logs/year=2024/month=01/day=05")
    assert leaf.count() == 2 and "year" not in leaf.columns
    days = leaf.select(day_from_path().alias("d")).distinct().collect()
    assert [str(r.d) for r in days] == ["2024-01-05"]
    assert values(stored_days(spark, f"{folder}/logs").distinct()) == [(2024, 1, 5), (2024, 11, 15)]
    # Values are written as they came.
    texts = read_raw(spark, f"{folder}/logs", infer=False)
    assert {r.timestamp for r in texts.collect()} == {"2024-01-05 10:00:00", "2024-01-05T10:00:00", "2024-11-15T00:00:00"}


def test_overwrite_modes_of_the_day_writer(spark, folder):
    base = f"{folder}/logs"
    two_days = raw(spark, {}, {"timestamp": "2024-01-06T00:00:00"})
    one_day = raw(spark, {}, {})
    write_by_day(two_days, base)
    write_by_day(two_days, base)
    assert read_logs(spark, base).count() == 4
    write_by_day(one_day, base, overwrite="dynamic")
    assert read_logs(spark, base).count() == 4 and read_logs(spark, base).filter("day = 5").count() == 2
    write_by_day(one_day, base, overwrite="static")
    assert read_logs(spark, base).count() == 2
    write_by_day(one_day, f"{folder}/columnar", fmt="parquet")
    assert spark.read.parquet(f"{folder}/columnar").count() == 2


def test_inferred_raw_zone(spark, folder):
    write_csv(folder, "a.csv", [LINE])
    assert dict(read_raw(spark, folder).dtypes)["bytes_transferred"] == "int"
    assert dict(read_raw(spark, folder, infer=False).dtypes)["bytes_transferred"] == "string"


def test_glob_base():
    assert glob_base("/data/logs") is None
    assert glob_base("/data/logs/*/*/*") == "/data/logs"
    assert glob_base("/data/logs/year=20*/x") == "/data/logs"


def test_marks(spark, folder):
    path = f"{folder}/mark"
    assert read_hwm(spark, path) is None
    write_hwm(spark, path, "2024-01-05")
    write_hwm(spark, path, at("2024-01-06").date())
    assert read_hwm(spark, path) == "2024-01-06"


def test_only_a_missing_mark_reads_as_none(spark):
    with pytest.raises(Exception) as error:
        read_hwm(spark, "nosuchscheme://x/mark")
    assert "PATH_NOT_FOUND" not in str(error.value)


def test_view_in_columnar_form(spark, folder):
    write_view(logs(spark, {}), f"{folder}/v")
    write_view(logs(spark, {}, {}), f"{folder}/v")
    assert spark.read.parquet(f"{folder}/v").count() == 2


def test_envelope_round_trip(spark):
    frame = logs(
        spark, {}, {"source_ip": None, "threat_label": None, "bytes_transferred": None},
        {"event_time": at("2024-01-05 10:00:00.250000"), "request_path": '/"x"\\'}, {"event_time": None},
    )
    messages = encode_envelope(frame)
    assert {bytes(r.key) for r in messages.collect()} == {b"10.0.0.1", b"0.0.0.0"}
    # All keys are present, also those of NULL fields.
    assert all(list(json.loads(bytes(r.value))) == list(LOG_FIELDS) for r in messages.collect())
    assert values(decode_envelope(messages), *frame.columns) == values(frame)


def test_bad_messages_keep_their_row(spark):
    texts = ["{bad", '{"timestamp": "2024-01-05 10:00:00", "bytes_transferred": 5, "user_agent": ""}', None, '{"timestamp": "x"}']
    messages = spark.createDataFrame([(None, t.encode() if t else None) for t in texts], "key binary, value binary")
    got = decode_envelope(messages)
    assert got.count() == 4
    assert values(got.filter("event_time is not null"), "event_time", "bytes_transferred", "user_agent") == [
        (at("2024-01-05 10:00"), 5, None)
    ]
    assert got.filter("coalesce(source_ip, request_path, string(event_time)) is null").count() == 3


class FileClient:
    """Writes each batch to a file of its own; runs in the Python workers."""

    def __init__(self, folder):
        self.folder = folder

    def put(self, rows):
        with open(os.path.join(self.folder, uuid.uuid4().hex), "w") as f:
            json.dump(rows, f, default=str)

    def close(self):
        pass


def received(folder):
    batches = []
    for name in os.listdir(folder):
        with open(os.path.join(folder, name)) as f:
            batches.append(json.load(f))
    return batches


class BrokenClient(FileClient):
    def put(self, rows):
        raise OSError("store is down")


def _worker_modules():
    # Test classes are sent to the workers by value, as these cannot import the test package.
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_partitions_are_written_in_batches(spark, folder):
    _worker_modules()
    stores.write_partitions(spark.range(0, 25, 1, 2), lambda: FileClient(folder), batch_size=10)
    batches = received(folder)
    assert sorted(len(b) for b in batches) == [2, 3, 10, 10]
    assert sorted(row["id"] for b in batches for row in b) == list(range(25))


def test_a_failing_store_fails_the_job(spark, folder):
    _worker_modules()
    with pytest.raises(Exception, match="store is down"):
        stores.write_partitions(spark.range(3), lambda: BrokenClient(folder))


def test_a_view_goes_to_both_stores(spark, tmp_path):
    _worker_modules()
    cells, points = str(tmp_path / "cells"), str(tmp_path / "points")
    os.mkdir(cells), os.mkdir(points)
    view = threat_timeline(logs(spark, {}, {"threat_label": None}))
    publish(view, "threat_timeline", lambda: FileClient(cells), lambda: FileClient(points))
    got = sorted((c["row_key"], c["qualifier"], c["value"]) for batch in received(cells) for c in batch)
    hour = "2024-01-05 10:00:00"
    assert got == [
        (hour, "event_count", "1"), (hour, "total_bytes", "100.0"),
        (f"benign#{hour}", "event_count", "1"), (f"benign#{hour}", "total_bytes", "100.0"),
    ]
    sent = sorted((str(p["tags"]), p["longs"]["event_count"], p["time"]) for batch in received(points) for p in batch)
    assert sent == [("{'threat_label': 'benign'}", 1, hour), ("{}", 1, hour)]


def test_fan_out_computes_a_view_once(spark):
    seen = []
    frame = spark.range(10).withColumn("r", F.rand())
    stores.fan_out(frame, [lambda df: seen.append(sorted(r.r for r in df.collect()))] * 2)
    assert seen[0] == seen[1] and not frame.is_cached


def test_raw_logs_keep_file_order_of_fields(spark):
    assert raw_logs(logs(spark, {})).columns == list(LOG_FIELDS)
