"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as driver
from netwatch import rules
from netwatch.operators import detectors, filters, keyed, views
from netwatch.operators.enrich import raw_logs
from netwatch.operators import split
from netwatch.operators.split import replay_chunks
from netwatch.plans.increments import pending_days
from netwatch.sinks.days import write_by_day, write_view
from netwatch.sources.envelope import decode_envelope, encode_envelope
from netwatch.sources.logs import read_logs, stored_days
from tests.conftest import TESTDATA
from tests.helpers import at, logs, raw

TABLES = f"{TESTDATA}/sf0.001"
STATIC = [n for n in driver.QUERIES if not n.startswith(("stream_", "day_folders", "incremental"))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, folder):
    """The typed log as a columnar table."""
    write_view(logs(spark, {}, {"event_time": at("2024-01-06"), "threat_label": "malicious"}), f"{folder}/typed")
    return spark.read.parquet(f"{folder}/typed")


@pytest.mark.parametrize("name", STATIC)
def test_no_query_runs_python_or_a_cross_join(spark, name):
    text = plan(driver.QUERIES[name](spark, TABLES))
    for operator in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas", "SinglePartition, REPARTITION"):
        assert operator not in text, operator


def test_scans_read_the_needed_columns_only(stored):
    text = plan(views.reputation_counts(stored))
    assert "ReadSchema: struct<source_ip:string,threat_label:string>" in text
    assert "ReadSchema: struct<threat_label:string>" in plan(filters.threats_only(stored).select("threat_label"))


def test_filters_reach_the_scan(stored):
    assert "In(threat_label, [malicious,suspicious])" in plan(filters.threats_only(stored))
    assert "EqualTo(threat_label,malicious)" in plan(views.top_ips(stored))
    assert "GreaterThan(event_time," in plan(keyed.expire(stored, "event_time", 60, "2024-01-06"))


def test_one_shuffle_per_view_with_partial_aggregation(stored):
    for view in (
        views.ip_reputation(stored),
        views.attack_patterns(stored),
        views.threat_timeline(stored),
        detectors.detect_brute_force(stored),
        detectors.detect_data_exfil(stored),
        detectors.ip_scores(stored),
    ):
        text = plan(view)
        assert text.count("Exchange") == 1
        assert "partial_" in text


def test_increments_read_the_log_once(stored):
    text = plan(views.count_views(stored))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert text.count("RLIKE") == len(rules.BATCH_B)


def test_top_ips_does_not_sort_everything(stored):
    text = plan(views.top_ips(stored))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_versions_are_cut_before_the_shuffle(stored):
    text = plan(keyed.keep_versions(stored, ["source_ip"], ["event_time"], 5))
    assert "Partial" in text[text.index("Exchange"):]


def test_port_counts_spread_a_source_over_its_ports(stored):
    text = plan(views.port_scans(stored))
    assert text.count("Exchange") == 2 and "port" in text[text.rindex("Exchange"):].split("\n")[0]


def test_a_numbered_frame_is_not_shuffled(stored):
    assert "Exchange" not in plan(replay_chunks(stored, ["event_time"]))


def test_a_pass_of_a_split_skips_blocks_without_candidates(stored):
    rows = split._Rows(stored, "event_time", floor=0)
    cut = split.Cut(1, low=1_704_448_800_000_000, high=1_704_448_900_000_000)
    assert "GreaterThanOrEqual(event_time,2024-01-05" in plan(rows.near([cut]))


def test_messages_are_parsed_once(spark, stored, folder):
    write_view(encode_envelope(stored), f"{folder}/messages")
    read = decode_envelope(spark.read.parquet(f"{folder}/messages"))
    assert plan(detectors.detect_brute_force(read)).count("from_json") == 1
    assert plan(detectors.detect_signatures(read)).count("from_json") == 1


def test_older_day_folders_are_not_read(spark, folder):
    base = f"{folder}/logs"
    write_by_day(raw(spark, {}, {"timestamp": "2024-01-06T00:00:00"}), base)
    later = filters.after_mark(read_logs(spark, base), "2024-01-05")
    filters_line = next(line for line in plan(later).split("\n") if "PartitionFilters" in line)
    assert "make_date" in filters_line.split("PartitionFilters: [")[1].split("]")[0]
    assert len(later.inputFiles()) >= 1 and later.count() == 1


def test_days_are_listed_without_opening_logs(spark, folder):
    base = f"{folder}/logs"
    write_by_day(raw_logs(logs(spark, {})), base)
    assert "ReadSchema: struct<>" in plan(stored_days(spark, base))
    assert pending_days(spark, base, None).count() == 1
