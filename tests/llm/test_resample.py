"""Importance resampling against plain counts, and over whole small tables."""

import hashlib
import math
import zlib
from collections import Counter

import pytest

import __spark_entry__ as driver
from netwatch.llm import resample
from tests.llm import brute

TABLES = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, rank string, weight int, n_words int, _id int"
WORDS = "The quick brown fox jumps over the lazy dog near a river bank, it was 1 sunny day; ALL was well ö日本 "


def features(text, longest):
    words = brute.BENCH_WORD.findall(brute.lower(text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, longest=1, buckets=10_000, least=20, percent=10, seed="2024"):
    """docs: (id, text); target: texts."""

    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, longest)[1])

    s, t = counts(text for _, text in docs), counts(target)
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))

    rows = []
    for i, (doc_id, text) in enumerate(docs):
        n_words, own = features(text, longest)
        weight = sum(gain(zlib.crc32(f.encode()) % buckets) for f in own)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(own), weight, score, n_words >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    drawn = len(able) * percent // 100
    ranked = [(*r[:4], k if k <= drawn else None) for k, r in enumerate(able, 1)]
    return sort(ranked + [(*r[:4], None) for r in rows if not r[4]])


def sort(rows):
    return sorted(rows, key=lambda r: [(v is not None, v or 0) for v in r])


def result(frame):
    return sort(tuple(r) for r in frame.collect())


@pytest.mark.parametrize(("longest", "buckets", "percent"), [(1, 10_000, 10), (2, 97, 50), (3, 100_000, 100)])
def test_resampled(spark, longest, buckets, percent):
    texts = [None, "", " .,", "a", WORDS, WORDS * 2, WORDS * 2, "x " * 40_000, "z" * 60_000, WORDS.upper(), "a_b`c\x7fd{e " * 5]
    docs = [(i, t) for i, t in enumerate(texts * 3)] + [(None, WORDS), (None, WORDS), (5, WORDS), (5, "b " * 30)]
    target = [None, "", "the lazy dog is near the river", "sunny DAY 日本"]
    frame = spark.createDataFrame([(*d, "r", 1, 2, 3) for d in docs], SCHEMA).repartition(4)
    theirs = spark.createDataFrame([(t,) for t in target], "text string")
    found = resample.resampled(frame, theirs, buckets=buckets, longest=longest, percent=percent)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert result(found) == plain(docs, target, longest, buckets, percent=percent)


def test_empty_tables(spark):
    none, theirs = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "text string")
    assert resample.resampled(none, theirs).count() == 0
    docs = [(1, WORDS), (2, None)]
    frame = spark.createDataFrame([(*d, "r", 1, 2, 3) for d in docs], SCHEMA)
    assert result(resample.resampled(frame, theirs)) == plain(docs, [])


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").collect()]
    found = driver.queries()["op13_importance_resampling"](spark, TABLES)
    assert result(found.select("doc_id", "n_features", "weight", "score", "rank")) == plain(docs, target)
    assert [t for _, t in found.dtypes] == ["bigint"] * 5
