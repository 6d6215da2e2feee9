"""Importance resampling towards a target: words in hashed buckets, their gains summed, the highest noisy sums drawn.

Texts are lower-cased in A-Z and split by an untrained regular-expression pre-tokeniser, which gives each word with its
offsets. Windows over the offset pairs name the features: runs of one to ``longest`` words, joined by a blank. A
feature's bucket is its CRC modulo the number of buckets. Both tables are counted per bucket; a bucket's gain
is the logarithm of its share in the target over its share in the documents, and a text's weight the sum
of its features' gains. Gumbel noise that is fixed by the id then makes a draw without replacement of the highest sums.

Texts are split once: their buckets are written, counted, and read again for the weights. The gains, one number
per bucket, go to all tasks. Ranks come from a sort by range with the sizes of the ranges; no task
sees more than its range, and the driver one count per range.

Defined results: NULL, empty and word-less texts have weight 0 and are not drawn. Rows with equal ids share
their noise and are each drawn by their own weight, equal sums by id, then by number of features, then as they were
read. A NULL id counts as empty text in the noise and comes first among ties. An empty target has equal shares.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from netwatch.llm.tasks import saved, sliced, texts

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
SCALE = 1_000

# A word is a run of digits, letters after A-Z became a-z, and anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}

KEPT_FEATURES = 250_000


class Features:
    """The buckets of a text's features, in the order in which windows of one, two and more words begin."""

    def __init__(self, longest: int, buckets: int) -> None:
        self.longest, self.buckets = longest, buckets
        self.split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True).pre_tokenize_str
        self.known: dict[str, int] = {}

    def bucket(self, feature: str) -> int:
        found = self.known.get(feature)
        if found is None:
            if len(self.known) >= KEPT_FEATURES:
                for old in list(self.known)[: KEPT_FEATURES // 2]:
                    del self.known[old]
            found = self.known[feature] = zlib.crc32(feature.encode()) % self.buckets
        return found

    def of(self, text: bytes | None) -> tuple[int, list[int]]:
        """The number of words, and the bucket of each feature."""
        lowered = (text or b"").decode("utf-8", "replace").translate(LOWER)
        pairs = [pair for _, pair in self.split(lowered)]
        words = [lowered[start:stop] for start, stop in pairs]
        found = list(map(self.bucket, words))
        for n in range(2, self.longest + 1):
            found += [self.bucket(" ".join(words[at : at + n])) for at in range(len(words) - n + 1)]
        return len(words), found


def bucketed(frame: DataFrame, longest: int, buckets: int) -> DataFrame:
    """The columns before the text, ``n_words``, and ``buckets``: the bucket of each feature, in two or four bytes."""
    out = frame.drop("_text").schema.add("n_words", "long").add("buckets", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(longest, buckets)
        kind = "<u2" if buckets <= 1 << 16 else "<u4"
        for batch in batches:
            for part, values in sliced(batch):
                found = [features.of(value) for value in values]
                cells = [np.array(row, kind).tobytes() for _, row in found]
                arrays = [*part.columns[:-1], pa.array([n for n, _ in found], pa.int64()), pa.array(cells, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    return frame.mapInArrow(run, out)


def histogram(features: DataFrame, buckets: int) -> DataFrame:
    """``bucket`` and ``n`` of the buckets that occur: each task adds up its rows before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = "<u2" if buckets <= 1 << 16 else "<u4"
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for cell in batch.column(0):
                counts += np.bincount(np.frombuffer(cell.as_py(), kind), minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])

    found = features.select("buckets").mapInArrow(run, "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(ours: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """The gain of each bucket, from the two histograms: one row per bucket comes to the driver."""
    spark = ours.sparkSession
    both = (
        spark.range(buckets).withColumnRenamed("id", "bucket")
        .join(ours.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
    )
    sums = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    above = (F.col("t") + 1).cast("double") * (F.col("all_s") + buckets)
    below = (F.col("s") + 1).cast("double") * (F.col("all_t") + buckets)
    gain = F.floor(SCALE * F.log(above / below)).alias("gain")
    found = both.crossJoin(F.broadcast(sums)).select("bucket", gain).collect()  # a sum each: one row
    out = [0] * buckets
    for row in found:
        out[row.bucket] = row.gain
    return out


def weighed(features: DataFrame, gain: list[int], buckets: int) -> DataFrame:
    """The rows with ``n_features`` and ``weight`` in place of their buckets."""
    shared = features.sparkSession.sparkContext.broadcast(np.array(gain, np.int64))
    out = features.drop("buckets").schema.add("n_features", "long").add("weight", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = "<u2" if buckets <= 1 << 16 else "<u4"
        for batch in batches:
            rows = [np.frombuffer(cell.as_py(), kind) for cell in batch.column(batch.num_columns - 1)]
            cells = [pa.array([len(row) for row in rows], pa.int64()), pa.array([int(shared.value[row].sum()) for row in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cells], names=out.names)

    return features.mapInArrow(run, out)


def gumbel(key: Column, seed: str) -> Column:
    """Noise in thousandths, fixed by a seed and a key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, order: list[Column], percent: int) -> DataFrame:
    """The rows with their ``rank`` from 1 on in the order, NULL beyond the given share of them.

    The order must be total for ranks that do not depend on the layout.
    """
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = saved(laid.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_place")), "ranges")
    sizes = sorted((row["_range"], row["n"]) for row in ordered.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect())
    starts = [0, *accumulate(n for _, n in sizes)]
    drawn = percent * starts[-1] // 100
    offsets = ordered.sparkSession.createDataFrame(
        [(number, start) for (number, _), start in zip(sizes, starts)], "_range int, _start long"
    )
    # The lower 33 bits of the place are the row's number inside its range.
    rank = F.col("_start") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    joined = ordered.join(F.broadcast(offsets), "_range", "left")  # a row per range
    return joined.withColumn("rank", F.when(rank <= drawn, rank)).drop("_range", "_place", "_start")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: str = SEED,
) -> DataFrame:
    """``id_column``, ``n_features, weight, score, rank`` of each row; ``rank`` is NULL where it is not drawn."""
    frame = texts(docs, F.monotonically_increasing_id().alias("_row"), F.col(id_column).alias("_id"), text=text)
    ours = saved(bucketed(frame, longest, buckets), "features")
    theirs = bucketed(texts(target, text=target_text), longest, buckets)
    gain = gains(histogram(ours, buckets), histogram(theirs, buckets), buckets)
    rows = weighed(ours, gain, buckets).withColumn("score", F.col("weight") + gumbel(F.col("_id"), seed))
    able = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_first("_id"), F.asc("n_features"), F.asc("_row")]
    drawn = ranked(rows.filter(able), order, percent)
    rest = rows.filter(~able).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col("_id").alias(id_column), "n_features", "weight", "score", "rank"]
    return drawn.select(*columns).unionByName(rest.select(*columns))
