"""A quality score by a convolutional network over bytes, in numpy.

Each byte has a learned vector, and each filter weighs ``WIDTH`` successive ones, every ``STRIDE`` bytes. A chunk is
``2 * BLOCK`` such places and overlaps the next one by a half; all chunks together cover the whole text. A filter's answer in a
chunk is its greatest value there, at least 0. The mean and the greatest answer over the chunks of each filter go into
one logistic unit. Texts are followed by blanks up to the end of their last chunk.

The network is fitted on the driver on a sample with two bounds: at most ``SAMPLE_ROWS`` labelled rows, those of the
smallest hashes of id and label, and at most ``SAMPLE_BYTES`` of their texts. Only places where a maximum stands get a gradient. For scoring,
vectors and filters are multiplied out to a table over pairs of bytes, so that a text needs look-ups and sums only; the
table, of a fixed size, goes to all tasks, and texts are read in pieces of ``PIECE`` places.

Defined results: NULL and empty texts are scored like one blank chunk. Labels other than 0 and 1 are left out; a row with several labels
is learned with each. NULL ids have no label. Without any label the score is 0.5, and with labels of one
kind the share of ones, smoothed by one row of each kind. Rows with equal ids are scored each by its own text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netwatch.llm.tasks import numbered_names, per_text, remainder

SAMPLE_ROWS = 2_000
SAMPLE_BYTES = 8 << 20

WIDTH, STRIDE = 6, 2
VECTOR, FILTERS = 8, 24
BLOCK = 128
PIECE = 1 << 15
EPOCHS, LEAST_STEPS, BATCH, RATE = 5, 600, 16, 0.005
SHARES = WIDTH // STRIDE


@dataclass
class Network:
    """The parameters: a vector for each byte, filters over vectors, and the last unit."""

    vectors: np.ndarray
    filters: np.ndarray
    floors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.floors, self.weights, self.bias]

    def pair_table(self) -> np.ndarray:
        """What a pair of bytes adds to each filter, in each of the places of a filter that a pair can take."""
        single = np.einsum("bv,jvf->jbf", self.vectors, self.filters)
        pairs = [single[j][:, None, :] + single[j + 1][None, :, :] for j in range(0, WIDTH, STRIDE)]
        return np.ascontiguousarray(np.concatenate(pairs, axis=2).reshape(65536, SHARES * FILTERS), np.float32)


def started() -> Network:
    rng = np.random.default_rng(7)
    vectors = rng.normal(0, 0.5, (256, VECTOR))
    filters = rng.normal(0, (WIDTH * VECTOR) ** -0.5 * 2, (WIDTH, VECTOR, FILTERS))
    last = rng.normal(0, 0.1, 2 * FILTERS)
    return Network(*(np.asarray(a, np.float32) for a in (vectors, filters, np.zeros(FILTERS), last, np.zeros(1))))


def pairs_of(text: bytes) -> tuple[np.ndarray, int]:
    """The text's pairs of bytes as numbers, with blanks for the last filters, and its number of blocks."""
    places = -(-len(text) // STRIDE)
    blocks = max(2, -(-places // BLOCK))
    size = (blocks * BLOCK + SHARES - 1) * STRIDE
    return np.frombuffer(text.ljust(size)[:size], ">u2").astype(np.int64), blocks


def answers(text: bytes, table: np.ndarray, floors: np.ndarray) -> np.ndarray:
    """The greatest value of each filter in each block, piece by piece."""
    pairs, blocks = pairs_of(text)
    out = np.empty((blocks, FILTERS), np.float32)
    step = PIECE // BLOCK
    for first in range(0, blocks, step):
        last = min(blocks, first + step)
        n = (last - first) * BLOCK
        found = table[pairs[first * BLOCK : first * BLOCK + n + SHARES - 1]]
        total = found[:n, :FILTERS].copy()
        for j in range(1, SHARES):
            total += found[j : j + n, j * FILTERS : (j + 1) * FILTERS]
        out[first:last] = total.reshape(-1, BLOCK, FILTERS).max(axis=1)
    return np.maximum(out + floors, 0)


def pooled(blocks: np.ndarray) -> np.ndarray:
    """Mean and greatest answer over the chunks; a chunk is two neighbouring blocks."""
    chunks = np.maximum(blocks[:-1], blocks[1:])
    return np.concatenate([chunks.mean(axis=0, dtype=np.float64), chunks.max(axis=0)])


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -40, 40))))


def probability(text: bytes | None, table: np.ndarray, network: Network) -> float:
    features = pooled(answers(text or b"", table, network.floors))
    return logistic(float(features @ network.weights.astype(np.float64) + network.bias[0]))


def gradient(text: bytes, label: int, table: np.ndarray, net: Network, sums: list[np.ndarray]) -> None:
    """Adds the gradient of one text's loss to ``sums``."""
    pairs, n_blocks = pairs_of(text)
    n = n_blocks * BLOCK
    found = table[pairs]
    total = found[:n, :FILTERS].copy()
    for j in range(1, SHARES):
        total += found[j : j + n, j * FILTERS : (j + 1) * FILTERS]
    blocked = total.reshape(n_blocks, BLOCK, FILTERS)
    at = blocked.argmax(axis=1)
    value = np.take_along_axis(blocked, at[:, None, :], 1)[:, 0, :] + net.floors
    held = np.maximum(value, 0)
    left = held[:-1] >= held[1:]
    chunks = np.where(left, held[:-1], held[1:])
    best = chunks.argmax(axis=0)
    features = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)])
    error = logistic(float(features @ net.weights + net.bias[0])) - label
    sums[3] += error * features
    sums[4] += error
    up = np.full(chunks.shape, error / len(chunks), np.float32) * net.weights[:FILTERS]
    up[best, np.arange(FILTERS)] += error * net.weights[FILTERS:]
    per_block = np.zeros_like(held)
    per_block[:-1] += np.where(left, up, 0)
    per_block[1:] += np.where(left, 0, up)
    per_block *= value > 0
    sums[2] += per_block.sum(axis=0)
    block, column = np.nonzero(per_block)
    push = per_block[block, column]
    place = (block * BLOCK + at[block, column]) * STRIDE
    flat = np.frombuffer(text.ljust(n * STRIDE + WIDTH)[: n * STRIDE + WIDTH], np.uint8)
    for j in range(WIDTH):
        byte = flat[place + j]
        np.add.at(sums[1][j].T, column, push[:, None] * net.vectors[byte])
        np.add.at(sums[0], byte, push[:, None] * net.filters[j][:, column].T)


def fitted(rows: list[tuple[bytes, int]]) -> Network:
    """A network for texts and labels, by Adam with a falling rate. The order of the rows counts."""
    net = started()
    ones = sum(label for _, label in rows)
    net.bias[0] = np.log((ones + 1) / (len(rows) - ones + 1))
    if ones in (0, len(rows)):
        net.weights[:] = 0
        return net
    rng = np.random.default_rng(11)
    means = [np.zeros_like(p) for p in net.parameters()]
    squares = [np.zeros_like(p) for p in net.parameters()]
    per_epoch = -(-len(rows) // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // per_epoch))
    steps = epochs * per_epoch
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for first in range(0, len(rows), BATCH):
            batch = order[first : first + BATCH]
            sums = [np.zeros_like(p) for p in net.parameters()]
            table = net.pair_table()
            for i in batch:
                gradient(rows[i][0], rows[i][1], table, net, sums)
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for p, g, m, s in zip(net.parameters(), sums, means, squares):
                g /= len(batch)
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)
    return net


def held_out(id_column: str = "doc_id") -> Column:
    return remainder(F.col(id_column), 4) == 2


def sample(
    docs: DataFrame, labels: DataFrame, id_column: str, text: str, label: str, rows: int, n_bytes: int
) -> list[tuple[bytes, int]]:
    """Texts and labels of the rows to learn from, within both bounds, in the order of their hashes."""
    marked = labels.select(F.col(id_column).alias("_id"), F.col(label).cast("int").alias("_label"))
    marked = marked.filter(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & (remainder(F.col("_id"), 4) != 2))
    marked = marked.withColumn("_hash", F.xxhash64("_id", "_label")).orderBy("_hash", "_id").limit(rows)
    own = docs.select(F.col(id_column).alias("_id"), F.col(text).cast("binary").alias("_text"))
    found = own.join(F.broadcast(marked), "_id")  # at most as many rows as the bound
    size = F.coalesce(F.length("_text"), F.lit(0)).cast("long")
    # Copies of an id could outnumber the labels: the smallest hashes of the texts go first again.
    first = found.withColumn("_size", size).withColumn("_own", F.xxhash64("_text"))
    first = first.orderBy("_hash", "_id", "_own").limit(rows)
    total = F.sum("_size").over(Window.orderBy("_hash", "_id", "_own").rowsBetween(Window.unboundedPreceding, 0))
    chosen = first.withColumn("_total", total).filter(F.col("_total") <= n_bytes)
    kept = chosen.orderBy("_hash", "_id", "_own").select("_text", "_label").collect()
    return [(bytes(row["_text"] or b""), row["_label"]) for row in kept]


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = SAMPLE_ROWS,
    n_bytes: int = SAMPLE_BYTES,
) -> Network:
    """A network fitted on labelled rows that are not held out."""
    return fitted(sample(docs, labels, id_column, text, label, rows, n_bytes))


def scored(docs: DataFrame, network: Network, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns and the ``score`` of each row's text."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def make() -> Callable[[list], dict[str, list]]:
        table = shared.value.pair_table()
        return lambda values: {"score": [probability(value, table, shared.value) for value in values]}

    return per_text(docs, keep, "score double", make, text)


def good_only(docs: DataFrame, network: Network, least: float, text: str = "text") -> DataFrame:
    """The rows whose score reaches ``least``, with all their columns."""
    own = numbered_names(docs)
    found = scored(own, network, own.columns, f"_c{docs.columns.index(text)}")
    return found.filter(F.col("score") >= least).select(*own.columns).toDF(*docs.columns)
