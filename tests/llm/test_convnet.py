"""The byte network: its table against plain sums, its gradient against differences, and held-out accuracy."""

import numpy as np
import pytest

import __spark_entry__ as driver
from netwatch.llm import convnet
from tests.llm import brute

TABLES = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score string, quality int, _id int"


def plain(text, net):
    """The same network with each filter laid over each place by itself."""
    places = -(-len(text) // 2)
    blocks = max(2, -(-places // convnet.BLOCK))
    data = text.ljust(blocks * convnet.BLOCK * 2 + 4)
    spread = net.vectors[np.frombuffer(data, np.uint8)].astype(np.float64)
    values = np.array([np.einsum("jv,jvf->f", spread[2 * p : 2 * p + 6], net.filters) for p in range(blocks * convnet.BLOCK)])
    chunks = [np.maximum(values[b * convnet.BLOCK : (b + 2) * convnet.BLOCK].max(axis=0) + net.floors, 0) for b in range(blocks - 1)]
    features = np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0)])
    return 1 / (1 + np.exp(-(features @ net.weights + net.bias[0])))


TEXTS = [b"", b"a", "ö日本 text".encode() * 9, b"ab" * 128 + b"!", b"junk ### " * 300, bytes(range(256)) * 5]


@pytest.fixture(scope="module")
def net():
    rng = np.random.default_rng(0)
    found = convnet.started()
    found.floors[:] = rng.normal(0, 0.3, convnet.FILTERS)
    return found


def test_table_gives_the_same_as_filters(net):
    table = net.pair_table()
    for text in TEXTS:
        assert convnet.probability(text, table, net) == pytest.approx(plain(text, net), abs=1e-5)
    assert convnet.probability(None, table, net) == convnet.probability(b"", table, net)


def test_pieces_change_nothing(net, monkeypatch):
    table, text = net.pair_table(), b"some words, and %%% some ### other.\n" * 900
    whole = convnet.probability(text, table, net)
    monkeypatch.setattr(convnet, "PIECE", 2 * convnet.BLOCK)
    assert convnet.probability(text, table, net) == pytest.approx(whole, abs=1e-6)


def test_gradient(net):
    text, label, step = TEXTS[4] + TEXTS[2], 0, 1e-2
    sums = [np.zeros_like(p) for p in net.parameters()]
    convnet.gradient(text, label, net.pair_table(), net, sums)

    def loss():
        return -np.log(1 - plain(text, net))

    rng = np.random.default_rng(1)
    for parameter, found in zip(net.parameters(), sums):
        for i in [*rng.permutation(parameter.size)[:6], np.abs(found).argmax()]:
            before = parameter.flat[i]
            parameter.flat[i] = before + step
            above = loss()
            parameter.flat[i] = before - step
            below = loss()
            parameter.flat[i] = before
            assert found.flat[i] == pytest.approx((above - below) / (2 * step), rel=0.1, abs=2e-3)


def test_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{TABLES}/labels.parquet").collect()}
    found = driver.queries()["op12_byte_convnet"](spark, TABLES).collect()
    assert len(found) == spark.read.parquet(f"{TABLES}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    assert all(r.held_out == (brute.crc(r.doc_id) % 4 == 2) for r in found)
    held = [(labels[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)
    assert sum(p for a, p in held if a) >= 0.9 * sum(a for a, _ in held)


def test_sample_is_bounded_and_never_held_out(spark):
    docs = spark.createDataFrame([(i % 400, "x" * 100, None, 1, 1) for i in range(4_000)], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(None, 1), (3, 7), (4, None)], "doc_id long, quality int")
    found = convnet.sample(docs, labels, "doc_id", "text", "quality", 150, 10_000)
    assert len(found) == 100 and {label for _, label in found} <= {0, 1}
    marked = docs.filter(convnet.held_out()).limit(0).unionAll(spark.createDataFrame([(i, f"{i}", None, 1, 1) for i in range(400)], SCHEMA))
    learned = convnet.sample(marked, labels, "doc_id", "text", "quality", 1_000, 10_000)
    assert {int(t) for t, _ in learned} == {i for i in range(400) if brute.crc(i) % 4 != 2}


def test_edges(spark):
    texts = [None, "", " ", "日本", "long " * 60_000, "long " * 60_000]
    docs = spark.createDataFrame([(None if i == 3 else i, t, "s", 1, 2) for i, t in enumerate(texts)], SCHEMA)
    for marks, least, most in (([], 0.5, 0.5), ([(0, 1), (1, 1), (4, 1)], 0.6, 1), ([(4, 0), (5, 1), (0, 1)], 0, 1)):
        labels = spark.createDataFrame(marks, "doc_id long, quality int")
        scores = [r.score for r in convnet.scored(docs, convnet.train(docs, labels), ["doc_id", "score"]).collect()]
        assert len(scores) == 6 and all(least <= s <= most for s in scores) and scores[4] == scores[5]
    network = convnet.train(docs, labels)
    assert convnet.good_only(docs, network, 0.0).columns == docs.columns
    assert convnet.good_only(docs, network, 0.0).count() == 6
    assert convnet.scored(docs.limit(0), network, ["doc_id"]).count() == 0
