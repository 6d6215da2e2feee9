"""SimHash near-duplicates: fingerprints of word shingles, joined on blocks of bits, checked bit by bit.

A fingerprint of 64 bits is cut into ``BLOCKS`` blocks. Two that differ in at most ``MOST_BITS`` bits are
equal in at least ``BLOCKS - MOST_BITS`` blocks, so each fingerprint is filed under every choice of that
many blocks and all such pairs meet. With 7 blocks a key has 27 or 28 bits and there are 35 of them.

Equal fingerprints are one node, so that a group of copies, however large, is one row before the blocks
meet. In a bucket, nodes are taken from a shrinking set of those not yet reached: each bucket gives a
spanning forest of its links, never all pairs, and a bucket whose nodes are all alike is left after one
step. Components of the forests are those of all links.

Texts with a similarity of 0.8 differ in about ten bits, too many for blocks. Where a similarity is asked for
(``similar``), nodes are equal sets of shingles, links are found by the fingerprints as above, and each is checked by the
exact similarity of the two sets. Two more searches add the links that fingerprints miss, checked alike. One joins large
classes early: each text has ``SAMPLES`` fingerprints of samples, the ``SAMPLED``
shingles that come first in as many fixed orders, and each group of equal samples, and of equal pairs of samples, is
joined to three of its members. The last is complete: shingles have one order, those frequent in a part of the
texts last, and two sets of n shingles or fewer that are similar enough share one of their first
n - ceil(similar * n) + 1. Nodes of different classes that share one meet, unless their sizes or the parities
of their shingles in ``PARITIES`` bits show that they differ too much; neither bound ever drops a similar pair.

Defined results: a text without words (NULL and empty too) has fingerprint zero, which links like any
other. Each row gives one row; rows with the same id get the class of their own text. NULL ids never
name a class unless it has no other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netwatch.llm.links import components
from netwatch.llm.tasks import discard, numbered_names, per_text, saved

SEED = 42
BITS = 64
# Bits of the hashes of this many shingles are counted at one time.
COUNTED = 1 << 14
# Least similarity of near-duplicates.
SIMILAR = 0.8
# Frequent shingles are those that ``OFTEN`` texts or more of one in ``PART`` hold, the ``MOST_FREQUENT`` first of them. They
# decide how many pairs meet, never which links are found.
PART, OFTEN, MOST_FREQUENT = 16, 8, 100_000
PARITIES = 512
# Counts of shingles that tell large sets apart before whole sets meet.
CELLS = 1024
SAMPLES = 8
SAMPLED = 3
# Each sample has its own order: hashes are mixed with one of these, and the smallest come first.
ORDERS = np.arange(1, SAMPLES + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
MIXER = np.uint64(0xD6E8FEB86659FD93)


def shingle_hashes(text: bytes | None, size: int) -> np.ndarray:
    """The hash of each shingle of ``size`` words, repeats included."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and white space of ASCII only
    if not words:
        return np.empty(0, "<u8")
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    starts = stops - lengths
    last = max(1, len(words) - size + 1)
    spans = zip(starts[:last].tolist(), stops[min(size, len(words)) - 1 :].tolist())
    return np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), "<u8", last)


def majority(hashed: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashed), COUNTED):
        bits = np.unpackbits(hashed[at : at + COUNTED].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * ones > len(hashed)).tolist())


def fingerprint(text: bytes | None, size: int) -> int:
    """The fingerprint of the text's shingles of ``size`` words."""
    return majority(shingle_hashes(text, size))


def sample_fingerprints(hashed: np.ndarray) -> np.ndarray:
    """The fingerprint of each sample of the different hashes; the same for all orders of the shingles."""
    different = np.unique(hashed)
    best = np.empty((SAMPLES, 0), np.uint64)
    for at in range(0, len(different), COUNTED):
        mixed = (different[None, at : at + COUNTED] ^ ORDERS) * MIXER
        best = np.concatenate([best, mixed ^ (mixed >> np.uint64(32))], axis=1)
        if best.shape[1] > SAMPLED:
            best = np.partition(best, SAMPLED - 1, axis=1)[:, :SAMPLED]
    bits = np.unpackbits(np.ascontiguousarray(best).view(np.uint8).reshape(SAMPLES, -1, 8), axis=2, bitorder="little")
    over = (2 * bits.sum(axis=1, dtype=np.int64) > best.shape[1]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view(np.int64)[:, 0]


def fingerprints(docs: DataFrame, keep: list[str], size: int, text: str = "text") -> DataFrame:
    """The kept columns and ``fp``, the fingerprint as a signed long."""

    def make() -> Callable[[list], dict[str, list]]:
        return lambda values: {"fp": np.array([fingerprint(value, size) for value in values], np.uint64).view(np.int64)}

    return per_text(docs, keep, "fp long", make, text)


def frequent_shingles(docs: DataFrame, size: int, text: str) -> tuple[np.ndarray, np.ndarray]:
    """The hashes, in their order, of shingles frequent in a part of the texts, and their counts there."""
    part = docs.filter(F.pmod(F.xxhash64(F.col(text).cast("binary")), F.lit(PART)) == 0)

    def make() -> Callable[[list], dict[str, list]]:
        return lambda values: {"shingles": [np.unique(shingle_hashes(v, size)).view(np.int64) for v in values]}

    each = per_text(part, [], "shingles array<long>", make, text).select(F.explode("shingles").alias("shingle"))
    counts = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= OFTEN)
    found = counts.orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT).toArrow()
    hashes = found.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found.column("n").to_numpy()[order]


def digest(different: np.ndarray) -> bytes:
    """The name of a sorted set of hashes."""
    return xxhash.xxh3_128_digest(different.tobytes())


def parities(different: np.ndarray) -> np.ndarray:
    """Bits that tell whether an odd number of hashes falls on each. Two sets differ in at least as many hashes as bits."""
    odd = np.bincount((different % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def cells(different: np.ndarray) -> bytes:
    """How many hashes fall on each cell, up to 255. Two sets differ in at least as many hashes as these counts do."""
    held = np.bincount((different % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
    return np.minimum(held, 255).astype(np.uint8).tobytes()


def prefix(different: np.ndarray, similar: float, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first hashes in the common order, of which sets that are similar enough share one."""
    n = len(different)
    weight = np.zeros(n, np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, different), len(frequent) - 1)
        weight = np.where(frequent[at] == different, counts[at], 0)
    most = n - math.ceil(similar * n - 1e-6) + 1 if n else 0
    return different[np.lexsort((different, weight))[:most]]


def with_sets(docs: DataFrame, keep: list[str], size: int, text: str, similar: float) -> DataFrame:
    """The kept columns, the fingerprint, and what is known of the set of shingles: its name, size and so on."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, size, text))

    def make() -> Callable[[list], dict[str, list]]:
        def work(values: list) -> dict[str, list]:
            hashed = [shingle_hashes(value, size) for value in values]
            sets = [np.unique(h) for h in hashed]
            return {
                "fp": np.array([majority(h) for h in hashed], np.uint64).view(np.int64),
                "digest": [digest(s) for s in sets],
                "n": [len(s) for s in sets],
                "samples": [sample_fingerprints(s) for s in sets],
                "parity": [parities(s) for s in sets],
                "prefix": [prefix(s, similar, *shared.value).view(np.int64) for s in sets],
            }

        return work

    kinds = "fp long, digest binary, n long, samples array<long>, parity array<long>, prefix array<long>"
    return per_text(docs, keep, kinds, make, text)


def sample_links(nodes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` from members of each group of equal samples, or of equal pairs of samples, to all others.

    Those with ``again`` false come from the smallest node of a group. The others come from the first and
    the last member in an order of the group's own, so that texts which are not alike to one member of their
    groups meet by way of another.
    """
    sample = [F.col("samples")[i] for i in range(SAMPLES)]
    alone = [F.xxhash64(F.lit(i), one) for i, one in enumerate(sample)]
    paired = [F.xxhash64(F.lit(i), one, other) for i, (one, other) in enumerate(zip(sample, sample[1:] + sample[:1]))]
    filed = nodes.select("node", F.explode(F.array_distinct(F.array(*alone, *paired))).alias("key"))
    place = F.xxhash64("key", "node")
    groups = filed.groupBy("key").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("node").alias("smallest"),
        F.min_by("node", place).alias("first"),
        F.max_by("node", place).alias("last"),
    )
    groups = saved(groups.filter("_n > 1").drop("_n"), "groups")  # so that the join can split a hot group
    heads = F.array(*(F.struct(F.col(c).alias("head"), F.lit(c != "smallest").alias("again")) for c in groups.columns[1:]))
    links = filed.join(groups, "key").select("node", F.explode(heads).alias("h")).select("node", "h.*")
    links = links.filter(F.col("node") != F.col("head"))
    ends = F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")
    return links.groupBy(*ends).agg(F.min("again").alias("again"))


def not_too_far(links: DataFrame, nodes: DataFrame, similar: float) -> DataFrame:
    """The links but those that sizes or parities show to be too far apart."""
    for end in ("a", "b"):
        known = nodes.select(F.col("node").alias(end), F.col("n").alias(f"_n_{end}"), F.col("parity").alias(f"_p_{end}"))
        links = links.join(known, end)
    apart = sum(F.bit_count(F.col("_p_a")[i].bitwiseXOR(F.col("_p_b")[i])) for i in range(PARITIES // 64))
    most = (F.col("_n_a") + F.col("_n_b")) * ((1 - similar) / (1 + similar)) + 1e-6
    alike = F.least("_n_a", "_n_b") >= F.greatest("_n_a", "_n_b") * similar - 1e-6
    return links.filter(alike & (apart <= most)).select("a", "b")


def close_cells(links: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The links but those whose counts by cell show that the sets are too far apart."""
    for end in ("a", "b"):
        known = sets.select(F.col("end").alias(end), F.col("n").alias(f"_n_{end}"), F.col("cells").alias(f"_c_{end}"))
        links = links.join(known, end)
    rate = (1 - similar) / (1 + similar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                one, other = (
                    np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint8).reshape(-1, CELLS).astype(np.int16)
                    for i in (3, 4)
                )
                most = rate * part.column(2).to_numpy() + 1e-6
                near = pa.array(np.abs(one - other).sum(axis=1, dtype=np.int64) <= most)
                yield part.select([0, 1]).filter(near)

    both = links.select("a", "b", (F.col("_n_a") + F.col("_n_b")).cast("long").alias("n"), "_c_a", "_c_b")
    return both.mapInArrow(run, "a long, b long")


def prefix_links(nodes: DataFrame, labels: DataFrame, similar: float) -> DataFrame:
    """All pairs ``(a, b)`` of nodes of different classes that may be similar: they share one of their first shingles."""
    label = labels.select(F.col("node").alias("_node"), "label")
    own = nodes.join(label, F.col("node") == F.col("_node"), "left").drop("_node")
    own = saved(own.select("node", F.coalesce("label", "node").alias("label"), "n", "parity", "prefix"), "labelled")
    filed = own.select(F.explode("prefix").alias("key"), "node", "label")
    ends = filed.groupBy("key").agg(F.min("label").alias("_least"), F.max("label").alias("_most"))
    asked = saved(ends.filter("_least < _most").select("key"), "keys")  # keys of one class join nothing
    met = saved(filed.join(asked, "key"), "met")
    parts = [F.col("parity")[i].alias(f"p{i}") for i in range(PARITIES // 64)]
    rows = met.join(own.select("node", "n", "parity"), "node").select("key", "n", "node", "label", *parts).repartition("key").sortWithinPartitions("key", "n")
    rate = (1 - similar) / (1 + similar)

    def pairs(held: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        n, node, label, *parity = np.concatenate(held, axis=1)
        bits = np.array(parity).T.view(np.uint64)
        stops = np.searchsorted(n, n / similar + 1e-6, "right")
        a, b = [], []
        for i in range(len(n) - 1):
            there = slice(i + 1, stops[i])
            other = np.flatnonzero(label[there] != label[i]) + i + 1
            apart = np.bitwise_count(bits[other] ^ bits[i]).sum(axis=1, dtype=np.int64)
            other = other[apart <= rate * (n[other] + n[i]) + 1e-6]
            a.append(np.minimum(node[i], node[other]))
            b.append(np.maximum(node[i], node[other]))
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        key = None
        for batch in batches:
            cells = np.array([column.to_numpy() for column in batch.columns])
            if not batch.num_rows:
                continue
            cuts = np.flatnonzero(np.diff(cells[0])) + 1
            found: tuple[list, list] = ([], [])
            for block in np.split(cells, cuts, axis=1):
                if key is not None and block[0, 0] != key:
                    for out, new in zip(found, pairs(held)):
                        out += new
                    held = []
                key = block[0, 0]
                held.append(block[1:])
            yield edges(found)
        if held:
            yield edges(pairs(held))

    def edges(found: tuple[list, list]) -> pa.RecordBatch:
        none = np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *end])) for end in found], names=["a", "b"])

    found = saved(rows.mapInArrow(run, "a long, b long").distinct(), "found")
    discard(own, asked, met)
    return found


def similar_links(
    links: DataFrame, nodes: DataFrame, docs: DataFrame, id_column: str, text: str, size: int, similar: float
) -> DataFrame:
    """The links whose ends have sets of shingles that share at least ``similar`` of their union.

    The set of an end is that of the text which gives its class its name. An end without an id keeps no link.
    ``links`` is a written table, and is removed.
    """
    ends = links.select(F.explode(F.array("a", "b")).alias("end")).distinct()
    asked_nodes = nodes.join(ends, F.col("node") == F.col("end"))
    named = saved(asked_nodes.select("end", "first", F.col("digest").alias("_digest")), "ends")
    own = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_own"))
    asked = own.join(named.select("first").distinct(), F.col("_id") == F.col("first"), "left_semi")

    def make() -> Callable[[list], dict[str, list]]:
        def work(values: list) -> dict[str, list]:
            sets = [np.unique(shingle_hashes(value, size)) for value in values]
            return {
                "digest": [digest(s) for s in sets],
                "cells": [cells(s) for s in sets],
                "shingles": [s.view(np.int64) for s in sets],
            }

        return work

    found = per_text(asked, ["_id"], "digest binary, cells binary, shingles array<long>", make, "_own")
    found = found.join(named, (F.col("digest") == F.col("_digest")) & (F.col("_id") == F.col("first")))
    sets = saved(found.select("end", "cells", "shingles").dropDuplicates(["end"]), "shingles")
    close = saved(close_cells(links, sets.select("end", "cells", F.size("shingles").alias("n")), similar), "close")
    one = sets.select(F.col("end").alias("a"), F.col("shingles").alias("_of_a"))
    other = sets.select(F.col("end").alias("b"), F.col("shingles").alias("_of_b"))
    both = F.size(F.array_intersect("_of_a", "_of_b"))
    union = F.size("_of_a") + F.size("_of_b") - both
    checked = saved(close.join(one, "a").join(other, "b").filter(both >= similar * union).select("a", "b"), "similar")
    discard(links, named, sets, close)
    return checked


def block_keys(fp: Column, blocks: int, most: int) -> Column:
    """A key for each choice of ``blocks - most`` blocks: the number of the choice and the bits in it."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    keys = []
    for number, chosen in enumerate(combinations(masks, blocks - most)):
        mask = sum(chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(number).alias("choice"), fp.bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def forest(fps: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that join all of a bucket's distinct fingerprints that differ in at most ``most`` bits."""
    bits = fps.view(np.uint64)
    rest = np.arange(len(fps))
    out = []
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            node = front.pop()
            near = np.bitwise_count(bits[rest] ^ bits[node]) <= most
            if near.any():
                found = rest[near]
                out += [(int(fps[node]), int(fps[other])) for other in found]
                front += found.tolist()
                rest = rest[~near]
    return out


def bucket_links(sorted_rows: DataFrame, most: int) -> DataFrame:
    """Links within each run of equal ``(choice, bits)``; rows come sorted by these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        key = None

        def closed() -> list[tuple[int, int]]:
            return forest(np.concatenate(held), most) if sum(map(len, held)) > 1 else []

        for batch in batches:
            choice, bits, fps = (batch.column(i).to_numpy() for i in range(3))
            if not len(fps):
                continue
            cuts = np.flatnonzero((choice[1:] != choice[:-1]) | (bits[1:] != bits[:-1])) + 1
            starts = np.concatenate([[0], cuts])
            stops = np.concatenate([cuts, [len(fps)]])
            links: list[tuple[int, int]] = []
            last = len(starts) - 1
            # Runs of one row inside the batch have no links.
            for i in np.flatnonzero((stops - starts > 1) | np.isin(np.arange(last + 1), (0, last))).tolist():
                here = (choice[starts[i]], bits[starts[i]])
                if here != key:
                    links += closed()
                    held, key = [], here
                held.append(fps[starts[i] : stops[i]])
            yield edges(links)
        yield edges(closed())

    def edges(links: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return sorted_rows.mapInArrow(run, "a long, b long")


def unjoined(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The links between different components; a node without a label is a component of its own."""
    for end in ("a", "b"):
        label = labels.select(F.col("node").alias(end), F.col("label").alias(f"_of_{end}"))
        links = links.join(label, end, "left").withColumn(f"_of_{end}", F.coalesce(f"_of_{end}", end))
    return saved(links.filter("_of_a != _of_b").select("a", "b"), "unjoined")


def block_links(fps: DataFrame, blocks: int, most: int) -> DataFrame:
    """Links ``(a, b)`` that join all distinct fingerprints ``fp`` that differ in at most ``most`` bits."""
    filed = fps.select("fp", F.explode(block_keys(F.col("fp"), blocks, most)).alias("key"))
    filed = filed.select("key.choice", "key.bits", "fp").repartition("choice", "bits")
    return bucket_links(filed.sortWithinPartitions("choice", "bits"), most).distinct()


def fingerprint_links(marks: DataFrame, blocks: int, most: int) -> DataFrame:
    """Links ``(a, b)`` of nodes whose fingerprints differ in at most ``most`` bits; ``marks`` has each ``fp`` of each ``node``.

    The smallest node of a fingerprint stands for it, and is linked to all others that have it.
    """
    heads = saved(marks.groupBy("fp").agg(F.min("node").alias("head")), "heads")
    alike = marks.join(heads, "fp").select(F.col("head").alias("a"), F.col("node").alias("b"))
    near = block_links(heads, blocks, most)
    for end in ("a", "b"):
        head = heads.select(F.col("fp").alias(end), F.col("head").alias(f"_head_{end}"))
        near = near.join(head, end)
    both = alike.unionByName(near.select(F.col("_head_a").alias("a"), F.col("_head_b").alias("b"))).filter("a != b")
    found = saved(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "by-fingerprint")
    discard(heads)
    return found


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    size: int = 5,
    most: int = 4,
    blocks: int = 7,
    similar: float | None = None,
) -> DataFrame:
    """``id_column``, ``fp`` and ``component_id``, the smallest id of each row's class, for each row.

    Fingerprints link at ``most`` differing bits or fewer. With ``similar`` a link holds if the texts have that similarity,
    and the links that fingerprints miss at that similarity are added.
    """
    if similar is not None:
        return similar_classes(docs, id_column, text, size, similar, blocks, most)
    rows = saved(fingerprints(docs, [id_column], size, text), "fingerprints")
    nodes = saved(rows.groupBy("fp").agg(F.min(id_column).alias("first")), "nodes")
    joined = components(block_links(nodes, blocks, most))
    classes = nodes.join(joined, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )
    classes = saved(classes, "classes")
    first = classes.groupBy("label").agg(F.min("first").alias("component_id"))
    named = classes.join(first, "label").select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(named, F.col("fp") == F.col("_fp")).select(id_column, "fp", "component_id")


def similar_classes(
    docs: DataFrame, id_column: str, text: str, size: int, similar: float, blocks: int, most: int
) -> DataFrame:
    """As ``near_duplicates``, each link checked by the similarity of the sets of shingles."""
    own = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_own"))
    sets = saved(with_sets(own, ["_id"], size, "_own", similar), "fingerprints")
    alike = [F.first(name).alias(name) for name in ("n", "samples", "parity", "prefix")]
    grouped = sets.groupBy("digest").agg(F.min("_id").alias("first"), *alike)
    nodes = saved(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")
    rows = saved(sets.select("_id", "fp", "digest"), "rows")
    discard(sets)

    def checked(links: DataFrame) -> DataFrame:
        return similar_links(links, nodes, docs, id_column, text, size, similar)

    marks = saved(rows.select("digest", "fp").distinct().join(nodes.select("digest", "node"), "digest").select("fp", "node"), "marks")
    marked = fingerprint_links(marks, blocks, most)
    sampled = saved(sample_links(nodes), "links")
    early = marked.unionByName(sampled.filter("NOT again").select("a", "b")).distinct()
    links = checked(saved(not_too_far(early, nodes, similar), "near"))
    discard(marks, marked)
    # One link of each node to a smaller one joins most of a class; of the others only those that join more are kept.
    parents = saved(links.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "parents")
    labels = components(parents)
    again = unjoined(sampled.filter("again").select("a", "b"), labels)
    more = checked(saved(not_too_far(again, nodes, similar), "near"))
    links = parents.unionByName(unjoined(links, labels)).unionByName(more)
    found = prefix_links(nodes, components(links), similar)
    whole, nodes = nodes, saved(nodes.select("node", "first", "digest"), "nodes")
    discard(whole, sampled, again)
    joined = components(links.unionByName(checked(found)))
    classes = nodes.join(joined.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    classes = saved(classes.select("digest", "first", F.coalesce("label", "node").alias("label")), "classes")
    first = classes.groupBy("label").agg(F.min("first").alias("component_id"))
    named = classes.join(first, "label").select(F.col("digest").alias("_digest"), "component_id")
    found = rows.join(named, F.col("digest") == F.col("_digest"))
    return found.select(F.col("_id").alias(id_column), "fp", "component_id")


def first_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The row with the smallest id of each class of texts at ``SIMILAR`` or more, whole. Of rows with that id and the same text one stays; different texts under one
    id all stay, as an id alone does not make them copies.

    Rows with a NULL id all stay: none can be told from the other.
    """
    found = near_duplicates(docs, id_column, text, **{"similar": SIMILAR} | options)
    first = found.filter(F.col(id_column) == F.col("component_id")).select(F.col(id_column).alias("_first")).distinct()
    own = numbered_names(docs)
    name = f"_c{docs.columns.index(id_column)}"
    kept = own.join(first, F.col(name) == F.col("_first"), "left_semi").dropDuplicates([name, f"_c{docs.columns.index(text)}"])
    return kept.unionByName(own.filter(F.col(name).isNull())).toDF(*docs.columns)
