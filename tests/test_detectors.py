from netwatch.operators.detectors import detect_brute_force, detect_data_exfil, detect_signatures, ip_scores
from tests.helpers import at, logs, values

NOW = "2024-02-01"


def test_brute_force_threshold_and_window_edge(spark):
    def tries(n, ip, time):
        return [{"source_ip": ip, "action": "blocked", "event_time": at(time)}] * n

    frame = logs(
        spark,
        *tries(4, "a", "2024-01-05 10:00:00"),
        *tries(1, "a", "2024-01-05 10:01:00"),
        *tries(4, "b", "2024-01-05 10:00:00"),
        *tries(1, "b", "2024-01-05 10:00:59.999"),
        *tries(30, "c", "2024-01-05 10:00:30"),
        *({"source_ip": "d", "event_time": None, "action": "blocked"} for _ in range(9)),
    )
    assert values(detect_brute_force(frame, as_of=NOW)) == [
        ("b", at("2024-01-05 10:00"), 5, 0.25, at(NOW)), ("c", at("2024-01-05 10:00"), 30, 1.0, at(NOW)),
    ]


def test_exfiltration_threshold(spark):
    frame = logs(
        spark,
        {"source_ip": "a", "bytes_transferred": 10_000_000},
        {"source_ip": "b", "bytes_transferred": 10_000_000}, {"source_ip": "b", "bytes_transferred": 1},
        {"source_ip": "c", "bytes_transferred": None},
    )
    got = values(detect_data_exfil(frame, as_of=NOW), "source_ip", "total_bytes")
    assert got == [("b", 10_000_001)]


def test_scores_weigh_labels(spark):
    frame = logs(
        spark,
        {"threat_label": "malicious"}, {"threat_label": None, "event_time": at("2024-01-05 10:04:59")},
        {"threat_label": "malicious", "event_time": at("2024-01-05 10:05:00")}, {"source_ip": None},
    )
    got = values(ip_scores(frame), "source_ip", "window_start", "attack_count", "is_blocked", "last_seen")
    assert got == [
        ("10.0.0.1", at("2024-01-05 10:00"), 2, False, at("2024-01-05 10:04:59")),
        ("10.0.0.1", at("2024-01-05 10:05"), 1, True, at("2024-01-05 10:05")),
        (None, at("2024-01-05 10:00"), 1, False, at("2024-01-05 10:00")),
    ]
    assert dict(ip_scores(frame).dtypes)["threat_score"] == "float"
    assert dict(ip_scores(frame).dtypes)["attack_count"] == "int"


def test_score_of_seven_tenths_is_not_blocked(spark):
    rows = [{"threat_label": "malicious"}] * 4 + [{"threat_label": "suspicious"}] * 4 + [{"threat_label": "benign"}] * 0
    frame = logs(spark, *rows, {"threat_label": "suspicious"}, {"threat_label": "suspicious"})
    row = ip_scores(frame).first()
    assert abs(row.threat_score - 0.7) < 1e-6 and row.is_blocked is False


def test_signature_types_in_order(spark):
    frame = logs(
        spark,
        {"user_agent": "nikto/2", "request_path": "UNION SELECT"},
        {"request_path": "1 OR 1=1"},
        {"request_path": "alert(1)"},
        {"request_path": "/../x", "user_agent": None},
        {"request_path": "/"},
    )
    got = detect_signatures(frame, as_of=NOW)
    assert sorted(r.attack_type for r in got.collect()) == ["scanner_tool", "signature_match", "sqli", "xss"]
    assert len(got.columns) == 14
    row = got.first()
    assert row.threat_score == 0.8999999761581421 and row.window_start == row.window_end == at(NOW)
