"""The command line from a CSV log to views and alert tables."""

import pytest

import jobs
from netwatch.operators.detectors import ip_scores
from netwatch.operators.enrich import raw_logs, typed_logs
from netwatch.operators.views import ip_reputation
from netwatch.sources.events import logs_view, read_events
from netwatch.plans.publish import POINTS
from netwatch.sinks.committed import FileStore
from netwatch.sources.logs import read_raw
from netwatch.streaming.runs import TABLE_KEYS
from netwatch.streaming.tables import read_latest
from tests.conftest import TESTDATA
from tests.helpers import values


def test_from_log_to_views_and_alerts(spark, folder):
    logs = raw_logs(logs_view(read_events(spark, f"{TESTDATA}/sf0.001"), 60 * 24)).drop("event_id")
    logs.write.csv(f"{folder}/raw", header=True, escape='"')

    jobs.main(["split", f"{folder}/raw", f"{folder}/batch", f"{folder}/later"])
    batch, later = (read_raw(spark, f"{folder}/{part}", infer=False) for part in ("batch", "later"))
    assert (batch.count(), later.count()) == (750, 250)
    assert values(batch.unionByName(later)) == values(logs)

    jobs.main(["partition", f"{folder}/batch", f"{folder}/logs", f"{folder}/rejects"])
    jobs.main(["days", f"{folder}/logs", f"{folder}/state"])
    jobs.main(["views", f"{folder}/state", f"{folder}/views"])
    assert values(spark.read.parquet(f"{folder}/views/ip_reputation")) == values(ip_reputation(typed_logs(batch)))
    for _ in range(2):
        jobs.main(["publish", f"{folder}/state", f"{folder}/store"])
    cells = spark.read.parquet(*FileStore(f"{folder}/store/cells").paths())
    assert cells.count() == cells.select("row_key", "family", "qualifier").distinct().count() > 0
    assert cells.filter("qualifier = 'threat_count'").count() == ip_reputation(typed_logs(batch)).filter("row_key IS NOT NULL").count()
    points = spark.read.parquet(*FileStore(f"{folder}/store/points").paths())
    assert {r.measurement for r in points.select("measurement").distinct().collect()} == set(POINTS)
    jobs.main(["incremental", f"{folder}/logs", f"{folder}/other"])
    jobs.main(["views", f"{folder}/other", f"{folder}/others"])
    assert spark.read.parquet(f"{folder}/others/threat_timeline").count() > 0

    jobs.main(["replay", f"{folder}/later", "--folder", f"{folder}/messages"])
    jobs.main([
        "stream", f"{folder}/tables", f"{folder}/checkpoints", "--source", "parquet",
        "--option", f"path={folder}/messages", "--once", "--partitions", "2",
    ])
    table = read_latest(spark, f"{folder}/tables/ip_threat_scores", TABLE_KEYS["ip_threat_scores"])
    assert values(table) == values(ip_scores(typed_logs(later)))


def test_a_split_never_overwrites_its_input(folder):
    with pytest.raises(ValueError):
        jobs.main(["split", f"{folder}/raw", f"{folder}/raw", f"{folder}/later"])
