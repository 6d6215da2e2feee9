"""Benchmark contamination by winnowing: shared runs of words found by sampled fingerprints, then extended.

Of each ``WINDOW - K + 1`` successive hashes of K words the smallest ones are kept, so that each run of
``WINDOW`` words keeps a fingerprint that any equal run keeps too. Documents and items with a common
fingerprint are compared around it: words to both sides are added while they are equal, and a match of at
least ``WINDOW`` words is a hit. An item of fewer words is filed under the hash of all of it, and
documents give the hashes of each such length that occurs.

The items' fingerprints and words go to all tasks if they are no more than ``BROADCAST_WORDS`` words, and
documents are then read once and not shuffled. Beyond that, fingerprints are joined, and documents with a
common one meet their items by id of the row. Both ways call the same comparison and give the same rows.

Defined results: NULL, empty and word-less texts have no words and no hits; word-less items never occur.
Equal items are each reported. Rows with equal ids are judged each by its own text. Items with one id and several
texts are listed once if any of them occurs. A NULL item id counts for hits but is not listed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netwatch.llm.tasks import per_text, saved, sliced, texts, where

WINDOW = 10
K = 5
# About 50 MB of items in each Python worker.
BROADCAST_WORDS = 1_000_000
KEPT_WORDS = 400_000

# The bytes that are part of words, after A-Z became a-z.
WORD_BYTES = frozenset([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
SPACED = bytes(b if b in WORD_BYTES else 0x20 for b in range(256))

MIX = np.uint64(0x9E3779B97F4A7C15)


class Hashes(dict):
    """The hash of each word seen."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().translate(SPACED).split()


def hashed(words: list[bytes], known: Hashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of n words."""
    count = len(words) - n + 1
    if count < 1:
        return words[:0]
    out = words[:count] + np.uint64(n)
    for i in range(1, n):
        out *= MIX
        out ^= out >> np.uint64(29)
        out += words[i : i + count]
    out *= MIX
    return out ^ (out >> np.uint64(32))


def running(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The smallest or greatest of each ``width`` successive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def selected(hashes: np.ndarray, width: int) -> np.ndarray:
    """The places of those hashes that are the smallest of some window of ``width``, ties included."""
    if len(hashes) < width:
        return np.empty(0, np.int64)
    least = running(hashes, width, np.minimum)
    edge = np.full(width - 1, hashes.min(), np.uint64)
    return np.flatnonzero(hashes == running(np.concatenate([edge, least, edge]), width, np.maximum))


def marks(words: np.ndarray, shorts: list[int], window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of a text and their places: the winnowed ones, and all runs of the given lengths."""
    runs = grams(words, k)
    places = [selected(runs, window - k + 1)]
    prints = [runs[places[0]]]
    for n in shorts:
        all_of = grams(words, n) ^ np.uint64(n)
        prints.append(all_of)
        places.append(np.arange(len(all_of)))
    return np.concatenate(prints), np.concatenate(places)


def item_marks(words: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(words) >= window:
        return marks(words, [], window, k)
    return (grams(words, len(words)) ^ np.uint64(len(words)), np.zeros(1, np.int64)) if len(words) else (words, words)


class Items:
    """Items by fingerprint: where a text may share words with which item."""

    def __init__(self, rows: list[tuple], window: int, k: int) -> None:
        """Rows of id and text."""
        self.window, self.k = window, k
        known = Hashes()
        self.ids = [item for item, _ in rows]
        self.words = [words_of(text) for _, text in rows]
        self.places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for number, words in enumerate(self.words):
            prints, places = item_marks(hashed(words, known), window, k)
            for value, place in zip(prints.tolist(), places.tolist()):
                self.places[value].append((number, place))
        self.prints = np.array(sorted(self.places), np.uint64)
        self.shorts = sorted({len(words) for words in self.words if 0 < len(words) < window})

    def hits(self, words: list[bytes], known: Hashes) -> tuple[int, set[int]]:
        """How many words of a text are inside shared windows, and the numbers of their items."""
        prints, places = marks(hashed(words, known), self.shorts, self.window, self.k)
        if not len(self.prints):
            return 0, set()
        at = np.searchsorted(self.prints, prints)
        at[at == len(self.prints)] = 0
        same = np.flatnonzero(self.prints[at] == prints)
        if not len(same):
            return 0, set()
        hit = np.zeros(len(words), bool)
        items: set[int] = set()
        reached: dict[tuple[int, int], int] = {}  # by item and offset: where the last match ended
        order = same[np.argsort(places[same], kind="stable")]
        for value, place in zip(prints[order].tolist(), places[order].tolist()):
            for number, there in self.places[value]:
                if reached.get((number, place - there), -1) > place:
                    continue
                other = self.words[number]
                left = 0
                while left < min(place, there) and words[place - left - 1] == other[there - left - 1]:
                    left += 1
                right, most = 0, min(len(words) - place, len(other) - there)
                while right < most and words[place + right] == other[there + right]:
                    right += 1
                reached[number, place - there] = place + right
                if left + right >= min(self.window, len(other)):
                    hit[place - left : place + right] = True
                    items.add(number)
        return int(hit.sum()), items


COUNTS = "n_words long, n_hit long, item_ids array<string>"


def judged(items: Items, values: list, known: Hashes) -> dict[str, list]:
    out: dict[str, list] = {"n_words": [], "n_hit": [], "item_ids": []}
    for value in values:
        words = words_of(value)
        n_hit, numbers = items.hits(words, known)
        out["n_words"].append(len(words))
        out["n_hit"].append(n_hit)
        out["item_ids"].append(sorted({str(items.ids[n]) for n in numbers if items.ids[n] is not None}))
    return out


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    k: int = K,
    broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """The kept columns of each row, its ``n_words``, ``n_hit`` and the sorted ``item_ids`` that it shares."""
    items = benchmark.select(F.col(item).alias("_item"), F.col(item_text).cast("binary").alias("_words"))
    size = items.agg(F.sum(F.coalesce(F.length("_words") / 2, F.lit(0)) + 1)).first()[0] or 0
    if size > broadcast_words:
        return joined(docs, items, keep, text, window, k)
    shared = docs.sparkSession.sparkContext.broadcast([tuple(row) for row in items.collect()])

    def make() -> Callable[[list], dict[str, list]]:
        found, known = Items(shared.value, window, k), Hashes()
        return lambda values: judged(found, values, known)

    return per_text(docs, keep, COUNTS, make, text)


def joined(docs: DataFrame, items: DataFrame, keep: list[str], text: str, window: int, k: int) -> DataFrame:
    """The same rows for any number of items: fingerprints are joined, then documents with theirs."""
    lengths = items.mapInArrow(_short_lengths(window), "n int").distinct()
    shorts = sorted(row.n for row in lengths.collect())  # at most window - 1 numbers
    added = StructType.fromDDL(COUNTS)
    keep = [name for name in keep if name not in added.names]
    own = [F.col(name).alias(f"_c{i}") for i, name in enumerate(keep)]
    held = [f"_c{i}" for i in range(len(keep))]
    numbered = saved(texts(docs, *own, F.monotonically_increasing_id().alias("_row"), text=text), "numbered")
    theirs = items.mapInArrow(_item_prints(window, k), "print long, item string, words binary")
    ours = numbered.select("_row", "_text").mapInArrow(_prints(shorts, window, k), "print long, row long")
    pairs = ours.join(theirs, "print").select("row", "item", "words").distinct()
    lists = pairs.groupBy("row").agg(F.collect_list(F.struct("item", "words")).alias("_items"))
    frame = numbered.join(lists, F.col("_row") == F.col("row"), "left").select(*held, "_items", "_text")
    out = numbered.select(*held).schema
    for field in added:
        out = out.add(field.name, field.dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for batch in batches:
            for part, values in sliced(batch):
                found: dict[str, list] = {"n_words": [], "n_hit": [], "item_ids": []}
                for row, value in zip(part.column(part.num_columns - 2).to_pylist(), values):
                    own = Items([(r["item"], r["words"]) for r in row or ()], window, k)
                    for name, one in judged(own, [value], known).items():
                        found[name] += one
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()))
                arrays = [pa.array(v, kind) for v, kind in zip(found.values(), kinds)]
                yield pa.RecordBatch.from_arrays(part.columns[:-2] + arrays, names=out.names)

    return frame.mapInArrow(run, out).toDF(*keep, *added.names)


def _short_lengths(window: int):
    def run(batches):
        for batch in batches:
            lengths = {len(words_of(text)) for text in batch.column("_words").to_pylist()}
            yield pa.RecordBatch.from_pydict({"n": pa.array([n for n in lengths if 0 < n < window], pa.int32())})

    return run


def _item_prints(window: int, k: int):
    def run(batches):
        known = Hashes()
        for batch in batches:
            prints, names, words = [], [], []
            for item, text in zip(batch.column("_item").to_pylist(), batch.column("_words").to_pylist()):
                found = np.unique(item_marks(hashed(words_of(text), known), window, k)[0]).view(np.int64)
                prints += found.tolist()
                names += [None if item is None else str(item)] * len(found)
                words += [text] * len(found)
            yield pa.RecordBatch.from_pydict(
                {"print": pa.array(prints, pa.int64()), "item": pa.array(names, pa.string()),
                 "words": pa.array(words, pa.binary())}
            )

    return run


def _prints(shorts: list[int], window: int, k: int):
    def run(batches):
        known = Hashes()
        for batch in batches:
            for part, values in sliced(batch):
                found = [np.unique(marks(hashed(words_of(v), known), shorts, window, k)[0]) for v in values]
                rows = np.repeat(part.column(0).to_numpy(), [len(f) for f in found])
                prints = np.concatenate(found).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(prints), pa.array(rows)], names=["print", "row"])

    return run


def clean_only(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows without a hit, with all their columns."""
    return where(docs, lambda rows, keep, name: contaminated(rows, benchmark, keep, name, **options), "n_hit = 0", text)
