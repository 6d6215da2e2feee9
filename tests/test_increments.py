import os
import shutil

import pytest

from netwatch import rules
from netwatch.operators import views
from netwatch.operators.enrich import raw_logs
from netwatch.plans import increments
from netwatch.sinks.days import write_by_day
from netwatch.sources.events import logs_view, read_events
from netwatch.sources.logs import read_logs
from netwatch.sources.marks import read_hwm
from tests.conftest import TESTDATA
from tests.helpers import raw, values

AS_OF = "2024-02-01"
DAY = "CAST(event_time AS DATE)"


@pytest.fixture
def few_days(spark):
    return logs_view(read_events(spark, f"{TESTDATA}/sf0.001")).filter(f"{DAY} < DATE '2024-01-05'").drop("event_id")


def add(df, base):
    write_by_day(raw_logs(df), base)


def test_increments_add_up_to_a_full_run(spark, folder, few_days):
    base, state = f"{folder}/logs", f"{folder}/state"
    add(few_days.filter(f"{DAY} <= DATE '2024-01-02'"), base)
    assert increments.run_incremental(spark, base, state, as_of=AS_OF) == "2024-01-02"
    add(few_days.filter(f"{DAY} > DATE '2024-01-02'"), base)
    assert increments.run_incremental(spark, base, state, as_of=AS_OF) == "2024-01-04"
    full = read_logs(spark, base)
    assert values(increments.merged_reputation(spark, state)) == values(views.ip_reputation(full))
    assert values(increments.merged_patterns(spark, state)) == values(views.attack_patterns(full, as_of=AS_OF))
    assert values(increments.merged_timeline(spark, state)) == values(views.threat_timeline(full))


def test_a_run_without_new_rows_keeps_the_mark(spark, folder, few_days):
    base, state = f"{folder}/logs", f"{folder}/state"
    add(few_days, base)
    increments.run_incremental(spark, base, state, as_of=AS_OF)
    before = values(increments.merged_reputation(spark, state))
    assert increments.run_incremental(spark, base, state, as_of=AS_OF) == "2024-01-04"
    assert read_hwm(spark, f"{state}/mark") == "2024-01-04"
    assert values(increments.merged_reputation(spark, state)) == before


def test_a_run_that_failed_before_its_mark_counts_once(spark, folder, few_days, monkeypatch):
    base, state = f"{folder}/logs", f"{folder}/state"
    add(few_days.filter(f"{DAY} <= DATE '2024-01-02'"), base)
    increments.run_incremental(spark, base, state, as_of=AS_OF)
    add(few_days.filter(f"{DAY} > DATE '2024-01-02'"), base)

    def fail(*_):
        raise OSError("lost the driver")

    with monkeypatch.context() as broken:
        broken.setattr(increments, "write_hwm", fail)
        with pytest.raises(OSError):
            increments.run_incremental(spark, base, state, as_of=AS_OF)
    assert read_hwm(spark, f"{state}/mark") == "2024-01-02"
    increments.run_incremental(spark, base, state, as_of=AS_OF, partitions=4)
    assert values(increments.merged_reputation(spark, state)) == values(views.ip_reputation(few_days))


def test_views_without_any_attack_can_be_read(spark, folder):
    base, state = f"{folder}/logs", f"{folder}/state"
    write_by_day(raw(spark, {}), base)
    increments.run_incremental(spark, base, state, as_of=AS_OF)
    assert increments.merged_patterns(spark, state).count() == 0


def test_pending_days_compare_by_value(spark, folder):
    base = f"{folder}/logs"
    write_by_day(raw(spark, *({"timestamp": f"2024-{m}T00:00:00"} for m in ("02-10", "01-09", "01-31", "02-02"))), base)

    def pending(marker):
        return [str(r.day) for r in increments.pending_days(spark, base, marker).collect()]

    assert pending(None) == ["2024-01-09", "2024-01-31", "2024-02-02", "2024-02-10"]
    assert pending("2024-02-01") == ["2024-02-02", "2024-02-10"]
    assert pending("2024-02-10") == []


def test_days_run_in_order_and_stop_at_the_first_failure(spark, folder, few_days):
    base, state = f"{folder}/logs", f"{folder}/state"
    add(few_days, base)
    seen = []

    def flaky(session, path, where):
        seen.append(path[-6:])
        if path.endswith("day=03") and seen.count("day=03") == 1:
            raise OSError("bad day")
        increments.add_day(session, path, where)

    with pytest.raises(OSError):
        increments.run_days(spark, base, state, flaky)
    assert read_hwm(spark, f"{state}/mark") == "2024-01-02"
    assert increments.run_days(spark, base, state, flaky) == ["2024-01-03", "2024-01-04"]
    assert seen == ["day=01", "day=02", "day=03", "day=03", "day=04"]
    assert increments.run_days(spark, base, state) == []
    assert values(increments.merged_reputation(spark, state)) == values(views.ip_reputation(few_days))
    expected = views.attack_patterns(few_days, rules.BATCH_A).drop("last_seen")
    assert values(increments.merged_patterns(spark, state).drop("last_seen")) == values(expected)
    daily = increments.daily_reputation(spark, state)
    second = few_days.filter(f"{DAY} = DATE '2024-01-02'")
    assert values(daily.filter("detection_date = TIMESTAMP '2024-01-02'")) == values(
        views.ip_reputation(second, day="2024-01-02")
    )
    with pytest.raises(ValueError):
        increments.add_day(spark, f"{folder}/elsewhere", state)


def days_of(spark, *rows):
    return raw(spark, *({"timestamp": time, **more} for time, more in rows))


def put(df, base, folder_day):
    """Writes rows into a day folder, whatever their own times say."""
    year, month, day = folder_day.split("-")
    df.coalesce(1).write.mode("append").option("header", True).csv(f"{base}/year={year}/month={month}/day={day}")


def all_views(spark, state):
    return [values(merged(spark, state)) for merged in (increments.merged_reputation, increments.merged_patterns, increments.merged_timeline)]


def test_several_runs_give_what_one_run_gives(spark, folder):
    """Late files, a clock far ahead, rows without a time, a replaced file and one that went away."""
    base = f"{folder}/logs"
    bad = days_of(
        spark, ("2030-01-01T00:00:00", {}), ("bad", {"source_ip": "10.0.0.2"}), (None, {"request_path": "/?q=<script>"}),
        ("10:00:00", {}), ("2024-01-01T03:00:00", {"threat_label": None}),
    )
    put(bad, base, "2024-01-01")
    state = f"{folder}/many"
    assert increments.run_incremental(spark, base, state, as_of=AS_OF) == "2024-01-01"
    later = days_of(spark, *((f"2024-01-02T0{h}:00:00", {"source_ip": f"10.0.0.{h}"}) for h in range(3)))
    put(later, base, "2024-01-02")
    assert increments.run_incremental(spark, base, state, as_of=AS_OF) == "2024-01-02"
    put(days_of(spark, ("2024-01-01T09:00:00", {"request_path": "/?q=UNION SELECT"})), base, "2024-01-01")
    assert increments.run_incremental(spark, base, state, as_of=AS_OF) == "2024-01-02"
    full = f"{folder}/full"
    increments.run_incremental(spark, base, full, as_of=AS_OF)
    assert all_views(spark, state) == all_views(spark, full)
    assert sum(r.total_requests for r in increments.merged_reputation(spark, state).collect()) == 9

    name = next(n for n in os.listdir(f"{base}/year=2024/month=01/day=02") if n.endswith(".csv"))
    os.remove(f"{base}/year=2024/month=01/day=02/.{name}.crc")
    with open(f"{base}/year=2024/month=01/day=02/{name}", "a", encoding="utf-8") as log:
        log.write("2024-01-02T23:00:00,10.9.9.9,1.1.1.1,TCP,allowed,malicious,ids,5,x,/\n")
    increments.run_incremental(spark, base, state, as_of=AS_OF)
    increments.run_incremental(spark, base, f"{folder}/full2", as_of=AS_OF)
    assert all_views(spark, state) == all_views(spark, f"{folder}/full2")
    assert any(r.source_ip == "10.9.9.9" for r in increments.merged_reputation(spark, state).collect())

    shutil.rmtree(f"{base}/year=2024/month=01/day=02")
    assert increments.run_incremental(spark, base, state, as_of=AS_OF) == "2024-01-01"
    assert sum(r.total_requests for r in increments.merged_reputation(spark, state).collect()) == 6


def test_a_run_that_failed_before_its_ledger_changes_nothing(spark, folder, few_days, monkeypatch):
    base, state = f"{folder}/logs", f"{folder}/state"
    add(few_days.filter(f"{DAY} <= DATE '2024-01-02'"), base)
    increments.run_incremental(spark, base, state, as_of=AS_OF)
    before = all_views(spark, state)
    add(few_days, base)

    def fail(*_):
        raise OSError("lost the driver")

    with monkeypatch.context() as broken:
        broken.setattr(increments, "_commit", fail)
        with pytest.raises(OSError):
            increments.run_incremental(spark, base, state, as_of=AS_OF)
    assert all_views(spark, state) == before
    increments.run_incremental(spark, base, state, as_of=AS_OF)
    increments.run_incremental(spark, base, f"{folder}/full", as_of=AS_OF)
    assert all_views(spark, state) == all_views(spark, f"{folder}/full")


def test_without_a_change_no_log_is_read(spark, folder, few_days, monkeypatch):
    base, state = f"{folder}/logs", f"{folder}/state"
    add(few_days, base)
    increments.run_incremental(spark, base, state, as_of=AS_OF)
    monkeypatch.setattr(increments, "read_folders", None)
    assert increments.run_incremental(spark, base, state, as_of=AS_OF) == "2024-01-04"


def test_kinds_of_runs_are_not_mixed(spark, folder, few_days):
    base = f"{folder}/logs"
    add(few_days, base)
    increments.run_incremental(spark, base, f"{folder}/a", as_of=AS_OF)
    with pytest.raises(ValueError, match="incremental"):
        increments.run_days(spark, base, f"{folder}/a")
    increments.run_days(spark, base, f"{folder}/b")
    with pytest.raises(ValueError, match="days"):
        increments.run_incremental(spark, base, f"{folder}/b")


def test_views_of_a_state_without_runs_are_empty(spark, folder):
    assert increments.run_incremental(spark, f"{folder}/none", f"{folder}/state") is None
    assert all_views(spark, f"{folder}/state") == [[], [], []]
