from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netwatch.operators import detectors, views
from netwatch.operators.split import replay_chunks
from netwatch.schema import ENVELOPE_SCHEMA
from netwatch.sources.envelope import decode_envelope, encode_envelope
from netwatch.sources.events import logs_view, read_events, stream_events
from netwatch.sources.stream import read_stream
from netwatch.streaming import tables
from netwatch.streaming.runs import TABLE_KEYS, await_any, detector_tables, run_detectors, with_lateness
from tests.conftest import TESTDATA
from tests.helpers import logs, values

AS_OF = "2024-02-01"
NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """Four message files; file i holds slice i of each of four far-apart runs of the log."""
    folder = str(tmp_path_factory.mktemp("messages"))
    logs = logs_view(read_events(spark, f"{TESTDATA}/sf0.001"), 60)
    order = ["event_time", "event_id"]
    runs = replay_chunks(logs, order, name="run").persist()
    slices = [replay_chunks(runs.filter(F.col("run") == n), order, name="slice") for n in range(4)]
    mixed = reduce(DataFrame.unionByName, slices).persist()
    for part in range(4):
        chosen = mixed.filter(F.col("slice") == part).drop("run", "slice", "event_id")
        encode_envelope(chosen).coalesce(1).write.parquet(f"{folder}/{part}")
    for frame in (runs, mixed):
        frame.unpersist()
    return folder, logs.drop("event_id")


def start(spark, folder, root, **options):
    messages = read_stream(spark, "parquet", path=f"{folder}/*", maxFilesPerTrigger="1")
    assert messages.schema == ENVELOPE_SCHEMA
    return run_detectors(
        spark, decode_envelope(messages), f"{root}/tables", f"{root}/checkpoints",
        trigger=NOW, as_of=AS_OF, state_partitions=2, **options,
    )


def table(spark, root, name):
    return tables.read_latest(spark, f"{root}/tables/{name}", TABLE_KEYS[name])


def test_four_streams_equal_the_batch(spark, source, folder):
    messages, log = source
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    queries = start(spark, messages, folder)
    assert set(queries) == set(TABLE_KEYS)
    for query in queries.values():
        query.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions
    assert len(queries["ip_threat_scores"].recentProgress) >= 4
    for name, expected in detector_tables(log, as_of=AS_OF).items():
        got = table(spark, folder, name)
        assert got.columns == expected.columns
        assert values(got) == values(expected), name
    # A second run on the same checkpoints finds nothing new and changes nothing.
    before = values(table(spark, folder, "ip_threat_scores"))
    for query in start(spark, messages, folder).values():
        query.awaitTermination()
    assert values(table(spark, folder, "ip_threat_scores")) == before


def test_compaction_keeps_the_table(spark, source, folder):
    messages, _ = source
    start(spark, messages, folder, tables=["ip_threat_scores"])["ip_threat_scores"].awaitTermination()
    path, keys = f"{folder}/tables/ip_threat_scores", TABLE_KEYS["ip_threat_scores"]
    before = values(tables.read_latest(spark, path, keys))
    for upto in (1, 2, 2, 0):
        tables.compact(spark, path, keys, upto)
        assert values(tables.read_latest(spark, path, keys)) == before


def test_a_batch_that_runs_again_is_written_once(spark, folder):
    write = tables.upsert_batch(f"{folder}/t")
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2)], "k string, v int")
    write(old, 0)
    write(new, 1)
    write(new, 1)
    assert values(tables.read_latest(spark, f"{folder}/t", ["k"])) == [("a", 2), ("b", 1)]


def test_copies_of_a_signature_row_are_kept(spark, folder):
    copies = encode_envelope(logs(spark, *[{"request_path": "/?cmd=x"}] * 3))
    copies.repartition(3).write.parquet(f"{folder}/messages/0")
    stream = decode_envelope(read_stream(spark, "parquet", path=f"{folder}/messages/*", maxFilesPerTrigger="1"))
    name = "realtime_threats"
    query = run_detectors(spark, stream, folder, f"{folder}/c", tables=[name], trigger=NOW, state_partitions=2)[name]
    query.awaitTermination()
    assert tables.read_rows(spark, f"{folder}/{name}").count() == 3
    assert tables.read_latest(spark, f"{folder}/{name}", TABLE_KEYS[name]).count() == 1


def test_a_tight_watermark_loses_rows_and_a_wide_one_does_not(spark, source, folder):
    messages, logs = source
    total = detectors.ip_scores(logs).count()
    counts = {}
    for delay in (None, "10 minutes", "40 days"):
        stream = decode_envelope(read_stream(spark, "parquet", path=f"{messages}/*", maxFilesPerTrigger="1"))
        root = f"{folder}/{delay}"
        query = run_detectors(
            spark, with_lateness(stream, delay), root, f"{root}-checkpoints", tables=["ip_threat_scores"],
            trigger=NOW, state_partitions=2,
        )["ip_threat_scores"]
        query.awaitTermination()
        counts[delay] = tables.read_latest(spark, f"{root}/ip_threat_scores", TABLE_KEYS["ip_threat_scores"]).count()
    assert counts[None] == counts["40 days"] == total
    assert counts["10 minutes"] < total


def test_windowed_detectors_refuse_append_without_a_watermark(spark, folder):
    logs = logs_view(stream_events(spark, f"{TESTDATA}/sf0.001"))
    with pytest.raises(Exception, match="(?i)append"):
        detectors.ip_scores(logs).writeStream.outputMode("append").format("noop").option(
            "checkpointLocation", f"{folder}/c"
        ).start()


def test_port_scans_in_a_stream(spark, folder):
    logs = logs_view(stream_events(spark, f"{TESTDATA}/sf0.001"), 60)
    query = (
        views.port_scans(logs, min_ports=5)
        .writeStream.outputMode("update")
        .foreachBatch(tables.upsert_batch(f"{folder}/t"))
        .option("checkpointLocation", f"{folder}/c")
        .trigger(**NOW)
        .start()
    )
    query.awaitTermination()
    static = views.port_scans(logs_view(read_events(spark, f"{TESTDATA}/sf0.001"), 60), min_ports=5)
    assert not static.isEmpty()
    assert values(tables.read_latest(spark, f"{folder}/t", ["source_ip", "window_start"])) == values(static)


def test_a_failing_sink_ends_all_queries(spark, source, folder):
    messages, _ = source

    def sink(name):
        def write(batch, _):
            if name == "brute_force_alerts":
                raise OSError("store is down")

        return write

    stream = decode_envelope(read_stream(spark, "parquet", path=f"{messages}/*"))
    spark.streams.resetTerminated()
    queries = run_detectors(
        spark, stream, folder, f"{folder}/c", tables=["brute_force_alerts", "ip_threat_scores"],
        state_partitions=2, sink=sink,
    )
    with pytest.raises(Exception, match="store is down"):
        await_any(spark, queries)
    assert not any(query.isActive for query in queries.values())
    spark.streams.resetTerminated()


def test_kafka_source_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_stream(spark, "kafka", kafka__bootstrap__servers="localhost:1", subscribe="t")
