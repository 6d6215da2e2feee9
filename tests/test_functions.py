import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netwatch import rules
from netwatch.functions import scores, text, times
from netwatch.operators import enrich, filters
from tests.helpers import at, logs, raw, values


def one(spark, column, **inputs):
    frame = spark.range(1).select(*(F.lit(v).alias(k) for k, v in inputs.items()))
    return frame.select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "spelling, expected",
    [
        ("2024-01-05T10:00:00", dt.datetime(2024, 1, 5, 10)),
        ("2024-01-05 10:00:00", dt.datetime(2024, 1, 5, 10)),
        ("2024-01-05T10:00:00.25", dt.datetime(2024, 1, 5, 10, 0, 0, 250000)),
        ("bad", None),
        ("2024-13-05T10:00:00", None),
        ("", None),
    ],
)
def test_both_time_spellings_parse_and_bad_text_is_null(spark, spelling, expected):
    assert one(spark, times.parse_time(text.filled(F.col("t"))), t=spelling) == expected


def test_time_with_format_and_default(spark):
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    assert one(spark, times.parse_time(F.col("t"), iso), t="2024-01-05T10:00:00") == at("2024-01-05 10:00")
    assert one(spark, times.parse_time(F.col("t"), iso), t="2024-01-05 10:00:00") is None
    day = dt.datetime(2024, 2, 1)
    assert one(spark, times.parse_time(F.col("t"), default=day), t="bad") == day


def test_time_text_reads_back(spark):
    for value in (at("2024-01-05 10:00:00"), at("2024-01-05 10:00:00.120000")):
        written = one(spark, times.time_text(F.col("t")), t=value)
        assert "T" in written and " " not in written
        assert one(spark, times.parse_time(F.col("t")), t=written) == value


@pytest.mark.parametrize(
    "address, port", [("1.2.3.4", ""), ("1.2.3.4:443", "443"), ("h:99999999999", "99999999999"), (None, None)]
)
def test_destination_port(spark, address, port):
    column = F.lit(address).cast("string")
    assert one(spark, text.dest_port(column)) == port
    assert one(spark, text.dest_port(column, null_as="")) == (port or "")
    assert one(spark, text.port_number(column)) == (443 if port == "443" else None)


@pytest.mark.parametrize("given_text, number", [("12", 12), (" 12 ", 12), ("xx", None), ("", None), ("9" * 30, None)])
def test_bytes_number(spark, given_text, number):
    assert one(spark, text.bytes_number(F.col("b")), b=given_text) == number


def test_row_key_skips_null_parts(spark):
    hour = F.lit(at("2023-10-05 10:00:00"))
    assert one(spark, text.row_key(F.lit("m"), hour)) == "m#2023-10-05 10:00:00"
    assert one(spark, text.row_key(F.lit(None).cast("string"), hour)) == "2023-10-05 10:00:00"


def test_day_from_path(spark):
    path = "/logs/year=2024/month=01/day=05/part-0.csv"
    assert one(spark, times.day_from_path(F.col("p")), p=path) == dt.date(2024, 1, 5)
    assert one(spark, times.day_from_path(F.col("p")), p="/raw/x.csv") is None
    assert times.day_of_folder(path) == "2024-01-05"
    assert times.day_of_folder("/raw") is None


def test_capped_score_passes_through_float(spark):
    assert one(spark, scores.capped_score(F.lit(7), 20.0)) == 0.3499999940395355
    assert one(spark, scores.capped_score(F.lit(21), 20.0)) == 1.0


@pytest.mark.parametrize("label, weight", [("malicious", 1.0), ("suspicious", 0.5), ("benign", 0.1), (None, 0.1)])
def test_label_weight(spark, label, weight):
    assert one(spark, scores.label_weight(F.lit(label).cast("string"))) == weight


def test_decisions_at_the_threshold(spark):
    assert one(spark, scores.risk_level(F.lit(0.7))) == "LOW"
    assert one(spark, scores.risk_level(F.lit(0.71))) == "HIGH"
    assert one(spark, scores.is_blocked(F.lit(None).cast("double"))) is False


DOUBLES = [0.0, 1.0, -1.5, 0.1, 2 / 3, 1e-4, 9.999e-5, 1.5e-5, 1e7, 12345678.0, 123456789.25, 1e15, 9007199254740993.0,
           1e16, 1.25e22, 1e100, 5.684341886080802e-14, 2e23, 0.3499999940395355, float("nan"), float("inf"), -float("inf")]


def test_plain_text_of_doubles(spark):
    frame = spark.createDataFrame([(x,) for x in DOUBLES], "x double")
    got = [r.v for r in frame.select(text.plain_text(F.col("x"), T.DoubleType()).alias("v")).collect()]
    assert got == [str(x) for x in DOUBLES]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False), min_size=50, max_size=200))
def test_plain_text_of_doubles_reads_back(spark, numbers):
    frame = spark.createDataFrame([(x,) for x in numbers], "x double")
    got = [r.v for r in frame.select(text.plain_text(F.col("x"), T.DoubleType()).alias("v")).collect()]
    for x, written in zip(numbers, got):
        assert float(written) == x
        assert ("e" in written) == ("e" in str(x)) or math.isinf(x)


def test_plain_text_of_other_types(spark):
    assert one(spark, text.plain_text(F.lit(True), T.BooleanType())) == "True"
    assert one(spark, text.plain_text(F.lit(5), T.LongType())) == "5"
    for value in (at("2024-01-05 10:00:00"), at("2024-01-05 10:00:00.120000")):
        assert one(spark, text.plain_text(F.lit(value), T.TimestampType())) == str(value)
    assert one(spark, text.plain_text(F.lit(0.9).cast("float"), T.FloatType())) == "0.8999999761581421"


def test_rules_take_the_first_match(spark):
    paths = ["/x?<script>--", "/q?s=union select 1", "/img?onerror=x", "/sh?c=curl h | sh", "/run?cmd=/bin/bash", "/", None]
    frame = logs(spark, *({"request_path": p} for p in paths))
    b = enrich.classify_attack(frame, rules.BATCH_B).select("attack_type").collect()
    assert [r.attack_type for r in b] == [
        "SQL_Injection", "SQL_Injection", "XSS", "Command_Injection", "Command_Injection", "Normal", "Normal",
    ]
    a = enrich.classify_attack(frame, rules.BATCH_A).select("attack_type").collect()
    assert [r.attack_type for r in a] == ["XSS", "SQL_Injection", "Normal", "Normal", "Normal", "Normal", "Normal"]
    flags = enrich.flag_rules(frame, rules.BATCH_B).select(*rules.BATCH_B).collect()
    assert tuple(flags[0]) == (1, 1, 0)
    assert tuple(flags[-1]) == (0, 0, 0)


def test_typed_logs_bind_by_name(spark):
    shuffled = raw(spark, {"bytes_transferred": "xx", "user_agent": ""}).withColumn("response_code", F.lit("200"))
    shuffled = shuffled.select(*sorted(shuffled.columns))
    row = enrich.typed_logs(shuffled).first()
    assert row.request_path == "/index.html" and row.threat_label == "benign" and row.action == "allowed"
    assert row.bytes_transferred is None and row.user_agent is None
    assert "response_code" not in row.asDict()
    with pytest.raises(ValueError, match="source_ip"):
        enrich.typed_logs(shuffled.drop("source_ip"))


def test_failed_access_with_nulls(spark):
    frame = logs(
        spark,
        {"action": "blocked", "request_path": None},
        {"action": None, "request_path": "/Admin/LOGIN.php"},
        {"action": None, "request_path": "/"},
        {"action": "allowed", "request_path": None},
    )
    assert values(filters.failed_access(frame), "action", "request_path") == [
        ("blocked", None), (None, "/Admin/LOGIN.php"),
    ]


def test_signatures_are_case_sensitive_and_look_at_both_columns(spark):
    frame = logs(
        spark,
        {"request_path": "/q?s=union select 1"},
        {"request_path": "/q?s=UNION SELECT 1"},
        {"request_path": None, "user_agent": "sqlmap/1.7"},
        {"request_path": None, "user_agent": None},
    )
    assert values(filters.signature_rows(frame), "request_path") == [("/q?s=UNION SELECT 1",), (None,)]


def test_valid_days_splits_without_loss(spark):
    texts = ["2024-01-05T10:00:00", "2024-01-05 10:00:00", "2024", "2024-01", "bad", "", None]
    kept, rejected = filters.valid_days(raw(spark, *({"timestamp": t} for t in texts)))
    assert [r.timestamp for r in kept.collect()] == texts[:2]
    assert [r.timestamp for r in rejected.collect()] == texts[2:]


def test_after_mark(spark):
    frame = logs(spark, {"event_time": at("2024-01-05 23:59:59")}, {"event_time": at("2024-01-06 00:00:00")}, {"event_time": None})
    assert filters.after_mark(frame, None).count() == 3
    assert values(filters.after_mark(frame, "2024-01-05"), "event_time") == [(at("2024-01-06"),)]
