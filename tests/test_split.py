import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from netwatch.operators import split
from netwatch.sources.files import names_in
from tests.helpers import logs

NUMBERS = st.one_of(st.none(), st.integers(-3, 3), st.sampled_from([-(2**63) + 1, 2**63 - 1, 2**40]))
ROWS = st.lists(st.tuples(NUMBERS, st.one_of(st.none(), st.integers(0, 2)), st.sampled_from("xy")), max_size=25)


def key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row[:2])


@pytest.fixture(params=["few", "many", "missed"])
def passes(request, monkeypatch):
    """With few groups per pass and wide brackets, with many and narrow ones, and with brackets that miss the ranks."""
    if request.param == "few":
        monkeypatch.setattr(split, "BINS", 4)
        monkeypatch.setattr(split, "MARGIN", 0.3)
    elif request.param == "missed":
        monkeypatch.setattr(split, "_bracket", lambda cuts, *_: [split.Cut(c.rank, low=c.high, high=c.high) for c in cuts])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_split_is_exact_for_ties_nulls_and_copies(spark, passes, rows):
    df = spark.createDataFrame(rows, "a bigint, b int, c string")
    head, tail = (sorted((tuple(r) for r in part.collect()), key=str) for part in split.ordered_split(df, ["a", "b"]))
    assert len(head) == int(len(rows) * 0.75)
    assert sorted(head + tail, key=str) == sorted(rows, key=str)
    if head and tail:
        assert max(map(key, head)) <= min(map(key, tail))


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, st.integers(1, 5))
def test_chunks_have_equal_size_and_the_last_takes_the_rest(spark, passes, rows, n):
    df = spark.createDataFrame(rows, "a bigint, b int, c string")
    got = [tuple(r) for r in split.replay_chunks(df, ["a", "b"], n).collect()]
    size = len(rows) // n
    assert sorted((r[:3] for r in got), key=str) == sorted(rows, key=str)
    for chunk in range(n):
        inside = [r for r in got if r[3] == chunk]
        expected = size if chunk < n - 1 else len(rows) - size * (n - 1)
        assert len(inside) == expected
    ordered = sorted(got, key=lambda r: (r[3], key(r)))
    assert [key(r) for r in ordered] == sorted(key(r) for r in got)


def test_a_third_of_all_rows_may_be_copies_of_one(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 1500, id) AS t", "if(id % 3 = 0, 'copy', 'own') AS kind")
    got = split.replay_chunks(df, ["t"]).groupBy("chunk").count().collect()
    assert sorted(tuple(r) for r in got) == [(0, 750), (1, 750), (2, 750), (3, 750)]


@pytest.mark.parametrize("n", [2, 4, 8])
def test_a_cut_on_the_edge_of_a_bin_of_a_lower_level(spark, passes, n):
    df = spark.range(16).selectExpr("0L AS a", "int(id) AS b")
    got = sorted(tuple(r)[1:] for r in split.replay_chunks(df, ["a", "b"], n).collect())
    assert got == [(b, b // (16 // n)) for b in range(16)]


def test_many_cuts_through_many_ties(spark, passes):
    df = spark.range(600).selectExpr(
        "if(id % 11 = 0, NULL, id * 7919 % 13) AS a", "int(id * 104729 % 5) AS b", "id % 3 AS c"
    )
    got = [tuple(r) for r in split.replay_chunks(df, ["a", "b"], 7).collect()]
    assert sorted((r[:3] for r in got), key=str) == sorted((tuple(r) for r in df.collect()), key=str)
    assert [sum(1 for r in got if r[3] == c) for c in range(7)] == [85] * 6 + [90]
    assert [key(r) for r in sorted(got, key=lambda r: (r[3], key(r)))] == sorted(key(r) for r in got)


def test_the_smallest_number_and_null(spark, passes):
    df = spark.createDataFrame([(-(2**63),), (None,), (5,), (2**63 - 1,)], "a bigint")
    head, tail = split.ordered_split(df, ["a"], 0.5)
    assert {r.a for r in head.collect()} == {-(2**63), None} and {r.a for r in tail.collect()} == {5, 2**63 - 1}


def test_split_by_time_and_date(spark):
    df = logs(spark, *({"event_time": dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)} for m in range(8)))
    head, tail = split.ordered_split(df, ["event_time"], 0.5)
    assert head.count() == 4 and head.agg({"event_time": "max"}).first()[0] == dt.datetime(2024, 1, 1, 0, 3)
    assert tail.columns == df.columns
    with pytest.raises(TypeError):
        split.ordered_split(df, ["source_ip"])


def test_a_cut_among_rows_whose_nulls_change_places(spark):
    rows = [(1, "x", None)] * 3 + [(1, None, "x")] * 3
    head, tail = split.ordered_split(spark.createDataFrame(rows, "t int, a string, b string"), ["t"], 0.5)
    assert sorted(map(str, head.collect() + tail.collect())) == sorted(map(str, spark.createDataFrame(rows, "t int, a string, b string").collect()))
    assert head.count() == 3


def counted_reads(df):
    """The frame, and an accumulator of the rows that jobs read from it."""
    read = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    return df.mapInPandas(count, df.schema), read


@pytest.mark.parametrize("n", [1_000, 300_000])
def test_the_source_is_scanned_twice_at_any_size_and_once_more_for_ties(spark, n):
    own, read = counted_reads(spark.range(n, numPartitions=8).selectExpr("id * 7919 % 1000003 * 1000000007 AS t", "id"))
    head, _ = split.ordered_split(own, ["t", "id"])
    assert read.value == 2 * n
    assert head.count() == n * 3 // 4
    tied, read = counted_reads(spark.range(n, numPartitions=8).selectExpr("id % 3 AS t", "id"))
    chunks = split.replay_chunks(tied, ["t"])
    assert read.value == 3 * n
    assert [r["count"] for r in chunks.groupBy("chunk").count().collect()] == [n // 4] * 4


def test_kept_keys_are_few_and_removed(spark, monkeypatch):
    sizes, paths, enter = [], [], split._Kept.__enter__

    def seen(kept):
        rows = enter(kept)
        sizes.append(rows.count())
        paths.append(kept.path)
        return rows

    monkeypatch.setattr(split._Kept, "__enter__", seen)
    split.replay_chunks(spark.range(200_000).selectExpr("id * 7919 % 1000003 AS t"), ["t"])
    assert len(sizes) == 1 and sizes[0] < 200_000 * 3 * 4 * split.MARGIN
    assert not any(names_in(spark, path) for path in paths)
