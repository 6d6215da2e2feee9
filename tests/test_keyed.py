from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from netwatch.operators import keyed
from tests.helpers import at, values

ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 5), st.integers(0, 9)), max_size=20)
SMALL = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, t int, v int")


@SMALL
@given(ROWS, ROWS)
def test_upsert_is_idempotent_and_keeps_every_key(spark, current, batch):
    now, new = frame(spark, current), frame(spark, batch)
    once = keyed.upsert_latest(now, new, ["k"], ["t"])
    assert values(once) == values(keyed.upsert_latest(once, new, ["k"], ["t"]))
    best = {}
    for write, rows in enumerate((current, batch)):
        for k, t, v in rows:
            best[k] = max(best.get(k, (-1, -1, -1)), (t, write, v))
    assert values(once) == sorted(((k, t, v) for k, (t, _, v) in best.items()), key=str)


def test_batch_wins_without_an_order(spark):
    got = keyed.upsert_latest(frame(spark, [("a", 9, 9), ("b", 1, 1)]), frame(spark, [("a", 0, 0)]), ["k"])
    assert values(got) == [("a", 0, 0), ("b", 1, 1)]


def test_versions(spark):
    rows = [("a", t, t) for t in range(8)] + [(None, 1, 1)]
    got = values(keyed.keep_versions(frame(spark, rows), ["k"], ["t"], 5))
    assert got == [("a", 3, 3, 5), ("a", 4, 4, 4), ("a", 5, 5, 3), ("a", 6, 6, 2), ("a", 7, 7, 1), (None, 1, 1, 1)]


def test_many_versions_are_ranked_in_shares_first(spark):
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    rows = frame(spark, [("a", t, t) for t in range(200)])
    few = values(keyed.keep_versions(rows, ["k"], ["t"], 7))
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        assert values(keyed.keep_versions(rows, ["k"], ["t"], 7)) == few
    finally:
        spark.conf.set(key, before)


def test_expiry_is_strict(spark):
    rows = spark.createDataFrame([(at("2024-01-05"),), (at("2024-01-05 00:00:01"),)], "w timestamp")
    assert values(keyed.expire(rows, "w", 86_400, "2024-01-06")) == [(at("2024-01-05 00:00:01"),)]


def test_clustered_spreads_a_hot_key_in_order(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.col("id").alias("t"),
    )
    laid = keyed.clustered(rows.repartition(8), "k", [F.desc("t")]).select("k", "t", F.spark_partition_id().alias("p"))
    got = [tuple(r) for r in laid.collect()]
    assert [(k, t) for k, t, _ in got] == sorted(((k, t) for k, t, _ in got), key=lambda r: (r[0], -r[1]))
    assert len(got) == 4000


def test_clustered_spreads_copies_of_one_row(spark):
    rows = spark.range(0, 8000, 1, 8).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("t"))
    rows = rows.withColumn("k", F.lit("hot"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # So small a frame would be put into one partition again.
    try:
        laid = keyed.clustered(rows, "k", [F.col("t")]).select("t", F.spark_partition_id().alias("p"))
        got = [tuple(r) for r in laid.collect()]
    finally:
        spark.conf.unset(key)
    assert [t for t, _ in got] == sorted(r.t for r in rows.collect())
    copies = Counter(p for t, p in got if t == -1)
    assert sum(copies.values()) == 4000 and max(copies.values()) <= 2000
