"""Repeated passages by sliding spans of sentences.

Every run of ``RUN`` successive sentences of a text is hashed; a text with fewer is one run. A run of under
``FEWEST`` characters goes on until it has as many, and the last one of a text begins early enough; such longer runs
count as repeats of other texts only, so that a list of equal short lines stays. One or two sentences that hold
``WORDS`` words are runs too. A text of under ``FEWEST`` characters is one run, which equals whole texts only. Equal
runs meet under their hash; the first is that of the smallest id, then row, then place, and sentences inside any
other one are removed. Sentences end at ., ! or ? and their like in other scripts before white space, at the full-width
ones anywhere, and at line ends. White space around sentences is not compared. Characters of scripts without
spaces count as half a word each.

Counts are made before the shuffle. The repeated hashes are a table with one row each, and adaptive execution
splits the other side of their join where a passage stands in very many documents.

Defined results: NULL and empty texts have no sentences and stay as they are; rows with equal ids are
different texts; equal texts lose all but the first, however short. A passage that begins and ends inside sentences
has no run.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netwatch.llm.tasks import saved, sliced, texts

RUN = 3
FEWEST = 60
WORDS = 25

ENDS = ".!?\u2026\u203c\u2047-\u2049\u037e\u0589\u061f\u06d4\u0964\u0965\u104a\u104b\u1362\u1367\u17d4\u17d5"
SENTENCE = regex.compile(rf"[^\n]*?(?:[{ENDS}]+(?=\s|$)|[。！？｡．]+[」』）”’]*)|[^\n]+")
UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")


RUNS = "array<struct<hash:long,at:int,n:int>>"


def sentences(text: str) -> list[str]:
    """Consecutive parts that make up the text; each holds one sentence and what follows up to the next."""
    starts = [m.start() for m in SENTENCE.finditer(text) if m[0].strip()]
    if starts:
        starts[0] = 0
    return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]


def n_words(sentence: str) -> int:
    return len(sentence.split()) + (0 if sentence.isascii() else len(UNSPACED.findall(sentence)) // 2)


def spans(bare: list[str], size: int, fewest: int, words: int) -> list[tuple[int, int]]:
    """Where the runs of a text of at least ``fewest`` characters begin and stop."""
    count = len(bare)
    if count < size:
        found = [(0, count)]
    else:
        ends = [0, *accumulate(len(part) + 1 for part in bare)]  # with the line end that joins sentences
        found, stop = [], 0
        for at in range(count - size + 1):
            stop = max(stop, at + size)
            while stop < count and ends[stop] - ends[at] <= fewest:
                stop += 1
            if ends[stop] - ends[at] <= fewest:
                break
            found.append((at, stop))
        if not found or found[-1][1] < count:
            at = count - size
            while at and ends[count] - ends[at] <= fewest:
                at -= 1
            found.append((at, count))
    held = [n_words(part) for part in bare]
    for n in (1, 2):
        found += [(at, at + n) for at in range(count - n + 1) if sum(held[at : at + n]) >= words]
    return list(dict.fromkeys(found))


def runs(parts: list[str], size: int, fewest: int, words: int) -> list[tuple[int, int, int]]:
    """The hash of each run, the sentence that it starts at, and how many it holds."""
    bare = [part.strip() for part in parts]
    whole = "\n".join(bare)
    if len(whole) < fewest:
        named = [("\n" + whole, 0, len(bare))] if bare else []  # no other run begins with a line end
    else:
        named = [("\n".join(bare[a:b]), a, b - a) for a, b in spans(bare, size, fewest, words)]
    out = []
    for run, at, n in named:
        low = xxhash.xxh3_64_intdigest(run)
        out.append((low - (1 << 64) if low >> 63 else low, at, n))
    return out


def without_repeated_spans(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    size: int = RUN,
    fewest: int = FEWEST,
    words: int = WORDS,
) -> DataFrame:
    """``id_column``, ``kept`` (the text left), ``n_sentences`` and ``n_removed`` of each row."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(1)
        for batch in batches:
            for part, values in sliced(batch):
                found = [runs(sentences(v.decode("utf-8", "replace")), size, fewest, words) if v else [] for v in values]
                packed = [None if v is None else packer.compress(v) for v in values]
                columns = list(zip(*chain.from_iterable(found))) or [(), (), ()]
                cells = [pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int32(), pa.int32()))]
                offsets = pa.array([0, *accumulate(map(len, found))], pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(cells, ["hash", "at", "n"]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(packed, pa.binary()), lists], names=["_row", "_id", "packed", "runs"]
                )

    kind = docs.schema[id_column].dataType.simpleString()
    frame = texts(docs, F.monotonically_increasing_id().alias("_row"), F.col(id_column).alias("_id"), text=text)
    rows = saved(frame.mapInArrow(cut, f"_row long, _id {kind}, packed binary, runs {RUNS}"), "runs")
    flat = rows.select("_id", "_row", F.inline("runs"))
    place = F.struct("_id", "_row", "at")
    counts = flat.groupBy("hash").agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("first"))
    again = saved(counts.filter("_n > 1").select("hash", "first"), "spans")  # so that the join can split a hot hash
    later = flat.join(again, "hash").filter(
        (F.col("_row") != F.col("first._row")) | ((F.col("at") != F.col("first.at")) & (F.col("n") <= size))
    )
    places = later.groupBy("_row").agg(F.collect_list(F.struct("at", "n")).alias("places"))

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdDecompressor()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                kept, counts, removed = [], [], []
                for packed, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    value = None if packed is None else packer.decompress(packed).decode("utf-8", "replace")
                    parts = sentences(value) if value else []
                    gone = {i for run in found or () for i in range(run["at"], run["at"] + run["n"])}
                    kept.append("".join(p for i, p in enumerate(parts) if i not in gone) if gone else value)
                    counts.append(len(parts))
                    removed.append(len(gone))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(kept, pa.string()), pa.array(counts, pa.int64()),
                     pa.array(removed, pa.int64())], names=names,
                )

    names = [id_column, "kept", "n_sentences", "n_removed"]
    joined = rows.join(places, "_row", "left").select("_id", "packed", "places")
    return joined.mapInArrow(left, f"`{id_column}` {kind}, kept string, n_sentences long, n_removed long")
