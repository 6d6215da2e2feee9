from pyspark.sql import functions as F

from netwatch import rules
from netwatch.operators import days, detectors, serving, shaping, views
from tests.helpers import at, logs, values


def test_reputation_counts_nulls_as_documented(spark):
    frame = logs(
        spark,
        {"threat_label": "malicious"}, {"threat_label": None}, {"threat_label": "benign"},
        {"source_ip": None, "threat_label": "suspicious"},
    )
    got = values(views.ip_reputation(frame))
    assert got == [("10.0.0.1", 3, 1, 1 / 3, "LOW", "10.0.0.1"), (None, 1, 1, 1.0, "HIGH", None)]
    daily = views.ip_reputation(frame, day="2024-01-05", risk=False)
    assert daily.columns == ["source_ip", "total_requests", "threat_count", "threat_score", "row_key", "detection_date"]
    assert {r.detection_date for r in daily.collect()} == {at("2024-01-05")}


def test_merged_days_equal_the_whole(spark):
    one = logs(spark, {"threat_label": "malicious"}, {})
    two = logs(spark, {}, {"source_ip": "10.0.0.2"}, {"source_ip": None})
    parts = views.reputation_counts(one).unionByName(views.reputation_counts(two))
    merged = views.rate_reputation(views.merge_reputation(parts))
    assert values(merged) == values(views.ip_reputation(one.unionByName(two)))


def test_attack_patterns(spark):
    frame = logs(
        spark,
        {"request_path": "x--"}, {"request_path": "x--", "event_time": at("2024-01-06 01:00")},
        {"request_path": "onerror"}, {"request_path": "/"}, {"request_path": "y--"}, {"request_path": "z--", "event_time": None},
    )
    got = values(views.attack_patterns(frame, as_of="2024-02-01"), "row_key", "attack_count", "last_seen")
    stamp = at("2024-02-01")
    assert got == [
        ("SQL_Injection#2024-01-05", 2, stamp), ("SQL_Injection#2024-01-06", 1, stamp), ("SQL_Injection", 1, stamp),
        ("XSS#2024-01-05", 1, stamp),
    ]
    assert "last_seen" not in views.attack_patterns(frame, rules.BATCH_A, last_seen=False).columns


def test_timeline_sums_bytes_and_keeps_null_labels(spark):
    frame = logs(
        spark,
        {"event_time": at("2024-01-05 10:59:59"), "bytes_transferred": None}, {"bytes_transferred": 7},
        {"threat_label": None},
    )
    got = values(views.threat_timeline(frame), "row_key", "event_count", "total_bytes")
    assert got == [("2024-01-05 10:00:00", 1, 100.0), ("benign#2024-01-05 10:00:00", 2, 7.0)]


def test_top_ips_breaks_ties_by_address(spark):
    rows = [{"source_ip": ip, "threat_label": "malicious"} for ip in ("b", "a", "c", "c")] + [{"source_ip": "d"}]
    assert [tuple(r) for r in views.top_ips(logs(spark, *rows), 2).collect()] == [("c", 2), ("a", 1)]


def test_volume_without_sizes(spark):
    frame = logs(spark, {"bytes_transferred": None}, {"threat_label": "malicious"}, {"threat_label": "malicious", "bytes_transferred": 50})
    assert values(views.volume_analysis(frame)) == [("benign", 1, None, None, None), ("malicious", 2, 150, 75.0, 100)]


def test_port_scans_count_distinct_valid_ports(spark):
    targets = ["h:1", "h:2", "h:2", "h:70000", "h", None]
    got = values(views.port_scans(logs(spark, *({"dest_ip": d} for d in targets)), min_ports=2))
    assert got == [("10.0.0.1", at("2024-01-05 10:00"), 2, 3)]
    assert views.port_scans(logs(spark, *({"dest_ip": d} for d in targets)), min_ports=3).isEmpty()


def test_days(spark):
    frame = logs(spark, {}, {"event_time": at("2024-01-07 00:00")}, {"event_time": None})
    assert days.max_day(frame).first().max_day.isoformat() == "2024-01-07"
    assert days.day_count(frame).first().day_count == 2
    assert days.day_summary(frame).count() == 3
    assert [tuple(r) for r in days.list_days(frame).collect()] == [(2024, 1, 5), (2024, 1, 7)]
    # The marker is compared by value, also when its own day is not listed.
    assert [r.day.isoformat() for r in days.days_after(days.list_days(frame), "2024-01-06").collect()] == ["2024-01-07"]
    assert days.is_empty(frame.filter("false")) and not days.is_empty(frame)
    assert days.max_day(frame.filter("false")).first().max_day is None


def test_serving_view_keeps_sources_of_either_layer(spark):
    batch = spark.createDataFrame(
        [("a", 10, 0.9), ("b", 5, 0.1), (None, 1, 0.2)], "source_ip string, total_requests bigint, threat_score double"
    )
    speed = spark.createDataFrame(
        [("a", 0.5, at("2024-01-05")), ("c", 1.0, at("2024-01-05")), (None, 0.5, at("2024-01-05"))],
        "source_ip string, threat_score float, last_seen timestamp",
    )
    got = values(serving.serving_ip_risk(batch, speed), "source_ip", "batch_score", "live_score", "risk_score", "is_blocked")
    assert got == [
        ("a", 0.9, 0.5, 0.9, True), ("b", 0.1, None, 0.1, False), ("c", None, 1.0, 1.0, True), (None, 0.2, 0.5, 0.5, False),
    ]


def test_cells_skip_nulls_and_keyless_rows(spark):
    frame = spark.createDataFrame(
        [("k1", 3, 0.00005, True), ("k2", None, None, None), (None, 1, 1.0, False), ("k3", 1, 12345678.0, None)],
        "key string, n bigint, score double, ok boolean",
    )
    cells = shaping.to_cells(frame, "key", "info", {"n": "count", "score": "score", "ok": "ok"})
    assert values(cells) == [
        ("k1", "info", "count", "3"), ("k1", "info", "ok", "True"), ("k1", "info", "score", "5e-05"),
        ("k3", "info", "count", "1"), ("k3", "info", "score", "12345678.0"),
    ]


def test_points_keep_types_and_drop_nulls(spark):
    frame = spark.createDataFrame(
        [("a", 1, 0.5, True, "x", at("2024-01-05")), (None, None, None, None, None, None)],
        "ip string, n int, score float, ok boolean, note string, t timestamp",
    )
    points = shaping.to_points(frame, "m", ["ip"], ["n", "score", "ok", "note"], "t", as_of="2024-02-01")
    full, empty = sorted(points.collect(), key=lambda r: r.time)
    assert full.asDict() == {
        "measurement": "m", "tags": {"ip": "a"}, "longs": {"n": 1}, "doubles": {"score": 0.5}, "bools": {"ok": True},
        "strings": {"note": "x"}, "time": at("2024-01-05"),
    }
    assert (empty.tags, empty.longs, empty.doubles, empty.bools, empty.strings) == ({}, {}, {}, {}, {})
    assert empty.time == at("2024-02-01")
    # A DATE serves as time as well, and without fields of a type the map is empty.
    dated = shaping.to_points(frame.withColumn("t", F.to_date("t")), "m", [], [], "t", as_of="2024-02-01")
    assert dated.schema["time"].dataType.typeName() == "timestamp" and dated.first().longs == {}


def test_sums_beyond_bigint(spark):
    most = 2**63 - 1
    rows = logs(spark, *[{"bytes_transferred": most, "threat_label": "malicious"}] * 2)
    assert values(views.threat_timeline(rows), "total_bytes") == [(float(most),)]
    assert values(views.volume_analysis(rows), "total_bytes", "max_bytes") == [(most, most)]
    assert values(views.count_views(rows), "bytes") == [(most,)] * 3
    assert values(detectors.detect_data_exfil(rows), "total_bytes", "threat_score") == [(most, 1.0)]
