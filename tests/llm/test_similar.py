"""Near-duplicates by similarity where texts share a template or filler."""

import random
import string

from netwatch.llm import simhash
from netwatch.llm.tasks import saved
from tests.llm import brute


def words(rng, n):
    return ["".join(rng.choices(string.ascii_lowercase, k=6)) for _ in range(n)]


def test_pairs_among_texts_of_one_template(spark):
    """Each text is a template and words of its own; pairs share all but a few of these."""
    rng = random.Random(6)
    template = words(rng, 154)
    rows, pairs = [], {}
    for i in range(1_000):
        own = words(rng, 40)
        rows.append((2 * i, " ".join(template + own)))
        if i % 5 == 0:
            rows.append((2 * i + 1, " ".join(template + own[:26] + words(rng, 14))))
            pairs[2 * i + 1] = 2 * i
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, similar=0.8).collect()}
    assert got == {i: pairs.get(i, i) for i, _ in rows}


def test_repeated_filler_is_not_similarity(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(["ha"] * 300 + words(rng, 60))) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_duplicates(docs, similar=0.8).collect()
    assert len({r.fp for r in found}) == 1
    assert sorted((r.doc_id, r.component_id) for r in found) == brute.similar_classes(rows, 5, 0.8)
    assert simhash.first_of_each(docs).count() == 4


def test_fingerprints_find_links_of_their_own(spark, monkeypatch):
    """Without the two other searches, texts whose fingerprints are near each other still meet, and unlike ones do not."""
    rng = random.Random(8)
    rows, pairs = [], {}
    for i in range(30):
        own = words(rng, 300)
        copy = [*own]
        copy[rng.randrange(300)] = "new"
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(copy))]
        one, other = (brute.fingerprint(text, 5) for _, text in rows[-2:])
        if (one ^ other).bit_count() <= 4:
            pairs[2 * i + 1] = 2 * i
    rows += [(60 + i, " ".join(["ha"] * 300 + words(rng, 60))) for i in range(3)]
    assert len(pairs) > 10
    monkeypatch.setattr(simhash, "sample_links", lambda nodes: nodes.selectExpr("node a", "node b", "false again").limit(0))
    monkeypatch.setattr(simhash, "prefix_links", lambda nodes, *_: saved(nodes.selectExpr("node a", "node b").limit(0), "found"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, similar=0.8).collect()}
    assert got == {i: pairs.get(i, i) for i, _ in rows}
