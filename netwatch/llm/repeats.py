"""Repeated substrings of whole texts: every byte inside a string of ``LENGTH`` bytes that starts twice.

The method dealt sorts all suffixes by a difference cover. This operator keeps its plan (name a sample of
positions that any two equal strings share, rank by names, then settle what is left by comparing prefixes) but takes
the sample from the text itself: of each ``LENGTH``-byte window, the place of its smallest hash of ``GRAM``
bytes. Equal windows choose the same place, and about one byte in 85 is chosen, where a difference cover
needs one in eleven and several global sorts of them; see the README.

1. Each text is cut into segments of windows with the same chosen place. A segment carries the hash of
   its place, its name, and the hash of all its bytes, its form.
2. Segments whose name occurs once are left. Segments with a form that occurs twice are covered whole.
3. A name with several forms is at the edge of a repeat. One segment of each form is cut into windows,
   whose hashes are counted under the name: together for a name of few forms, in parts for a name of very many. Windows that occur twice cover their bytes.

Copies are counted before each shuffle, so that a passage in a third of all documents is one row per task.

Defined results: strings never cross rows; NULL and short texts lose nothing; rows with equal ids are
different texts; overlapping repeats within one text count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netwatch.llm.tasks import saved, sliced, texts

LENGTH = 200
GRAM = 32
# Window starts of one text that are worked on at one time.
PIECE = 1 << 19
# Forms of one name that are compared in one row; names with more are compared part by part.
FORMS = 256
# Windows of a form in one part, and forms of a name that share a part.
TOGETHER, SHARED = 8, 50_000

MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = 0xD1342543DE82EF95
INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, count: int) -> np.ndarray:
    """base ** 0, base ** 1 and so on, modulo 2 ** 64."""
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def spans(values: np.ndarray, have: int, want: int) -> np.ndarray:
    """Hashes of ``want`` successive items from hashes of ``have``; two that overlap, or touch, cover them."""
    while have < want:
        step = min(have, want - have)
        left, right = values[:-step] * MIX, values[step:]
        left ^= left >> np.uint64(32)
        values = (left + right) * np.uint64(2 * step + 1)
        values ^= values >> np.uint64(29)
        have += step
    return values


def gram_hashes(data: bytes, gram: int) -> np.ndarray:
    values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    values *= MIX
    return spans(values, 1, gram) if len(data) >= gram else values[:0]


def chosen(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes the place of the smallest, the first of equal ones."""
    low, at, done = hashes, np.arange(len(hashes), dtype=np.int32), 1
    while done < width:
        step = min(done, width - done)
        right = low[step:] < low[:-step]
        at = np.where(right, at[step:], at[:-step])
        low = np.minimum(low[:-step], low[step:])
        done += step
    return at


class Cutter:
    """Cuts texts into segments."""

    def __init__(self, length: int, gram: int) -> None:
        self.length, self.gram = length, gram
        self.up = powers(BASE, 1)
        self.down = powers(INVERSE, 1)

    def segments(self, data: bytes) -> tuple[np.ndarray, ...]:
        """Name, form, first window and last window of each segment."""
        found = [self._piece(data, at) for at in range(0, max(0, len(data) - self.length + 1), PIECE)]
        empty = [np.empty(0, kind) for kind in (np.int64, np.int64, np.int32, np.int32)]
        return tuple(np.concatenate(columns) for columns in zip(empty, *found))

    def _piece(self, data: bytes, offset: int) -> tuple[np.ndarray, ...]:
        data = data[offset : offset + PIECE + self.length - 1]
        hashes = gram_hashes(data, self.gram)
        places = chosen(hashes, self.length - self.gram + 1)
        cuts = np.flatnonzero(places[1:] != places[:-1]) + 1
        first = np.concatenate([[0], cuts])
        last = np.concatenate([cuts - 1, [len(places) - 1]])
        if len(self.up) < len(hashes):
            self.up, self.down = powers(BASE, len(hashes)), powers(INVERSE, len(hashes))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * self.up[: len(hashes)])])
        form = (sums[last + self.length - self.gram + 1] - sums[first]) * self.down[first]
        form ^= form >> np.uint64(31)
        form = form * MIX + (places[first] - first).astype(np.uint64)
        form = form * MIX + (last - first).astype(np.uint64)
        return (
            hashes[places[first]].view(np.int64),
            form.view(np.int64),
            (first + offset).astype(np.int32),
            (last + offset).astype(np.int32),
        )


def window_hashes(data: bytes, length: int, gram: int) -> np.ndarray:
    """A hash of each window of ``length`` bytes."""
    return spans(gram_hashes(data, gram), gram, length).view(np.int64)


def cut(docs: DataFrame, id_column: str, text: str, length: int, gram: int) -> DataFrame:
    """Each row with a number of its own, its text packed, and its segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, packer = Cutter(length, gram), zstandard.ZstdCompressor(1)
        for batch in batches:
            for part, values in sliced(batch):
                values = [value or b"" for value in values]
                found = [cutter.segments(value) for value in values]
                sizes = np.cumsum([0, *(len(f[0]) for f in found)]).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(column)))
                    for column in zip(*found)
                ]
                packed = pa.array([packer.compress(value) for value in values], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], packed, *lists], names=names)

    frame = texts(docs, F.monotonically_increasing_id().alias("_row"), F.col(id_column).alias("_id"), text=text)
    lists = "names array<long>, forms array<long>, firsts array<int>, lasts array<int>"
    schema = frame.drop("_text").schema.add("packed", "binary")
    names = [*schema.names, *(item.split()[0] for item in lists.split(", "))]
    kinds = {"_row": "long", "_id": docs.schema[id_column].dataType.simpleString(), "packed": "binary"}
    return frame.mapInArrow(run, ", ".join([*(f"{n} {k}" for n, k in kinds.items()), lists]))


SEGMENT = "_row long, name long, form long, n long, n_forms long, first int, data binary"


def edge_segments(rows: DataFrame, length: int) -> DataFrame:
    """The segments listed with each packed text, with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, found = batch.slice(at, 64), []
                for row, packed, listed in zip(*(column.to_pylist() for column in part.columns)):
                    data = packer.decompress(packed)
                    found += [
                        (row, s["name"], s["form"], s["n"], s["n_forms"], s["first"], data[s["first"] : s["last"] + length])
                        for s in listed
                    ]
                kinds = (*(pa.int64(),) * 5, pa.int32(), pa.binary())
                columns = list(zip(*found)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    names = [column.split()[0] for column in SEGMENT.split(", ")]
    return rows.select("_row", "packed", "listed").mapInArrow(run, SEGMENT)


RUNS = "_row long, first int, last int"


def run_batch(rows: list[int], starts: list[np.ndarray]) -> pa.RecordBatch:
    """Rising window starts of each row, as runs of successive ones."""
    out: list[tuple] = []
    for row, at in zip(rows, starts):
        cuts = np.flatnonzero(np.diff(at) != 1) + 1
        out += [(row, int(run[0]), int(run[-1])) for run in np.split(at, cuts)]
    columns = list(zip(*out)) or [()] * 3
    kinds = (pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["_row", "first", "last"])


def in_small_names(segments: DataFrame, length: int, gram: int) -> DataFrame:
    """Runs of the windows that occur twice among the forms of a name, a name at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts = [], []
            for listed in batch.column(0):
                forms = listed.as_py()
                hashes = [window_hashes(form["data"], length, gram) for form in forms]
                _, place, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
                twice = np.split(count[place] > 1, np.cumsum([len(h) for h in hashes])[:-1])
                for form, found in zip(forms, twice):
                    if form["n"] == 1 and found.any():
                        rows.append(form["_row"])
                        starts.append(np.flatnonzero(found) + form["first"])
            yield run_batch(rows, starts)

    lists = segments.groupBy("name").agg(F.collect_list(F.struct("_row", "n", "first", "data")).alias("forms"))
    return lists.select("forms").mapInArrow(run, RUNS)


PARTS = "name long, offset int, share int, rows array<long>, starts array<int>, single array<boolean>, hashes array<long>"


def in_large_names(segments: DataFrame, length: int, gram: int) -> DataFrame:
    """The same where a name has very many forms, which do not meet in one row.

    Equal windows start equally far before the name's place. So windows are dealt by that distance, and
    in a name of more than SHARED forms by their hash too; each task sends what it has of such a part in one row.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[tuple, list[list]] = {}
            for name, row, n, n_forms, first, data in zip(*(column.to_pylist() for column in batch.columns)):
                found = window_hashes(data, length, gram)
                named = np.flatnonzero(gram_hashes(data, gram).view(np.int64) == name)
                place = int(named[named >= len(found) - 1][0])
                shares = -(-n_forms // SHARED)
                for at, value in enumerate(found.tolist()):
                    part = parts.setdefault((name, (place - at) // TOGETHER, value % shares), [[], [], [], []])
                    for column, entry in zip(part, (row, first + at, n == 1, value)):
                        column.append(entry)
            keys, lists = list(zip(*parts)) or [()] * 3, list(zip(*parts.values())) or [()] * 4
            kinds = (pa.int64(), pa.int32(), pa.int32(), *map(pa.list_, (pa.int64(), pa.int32(), pa.bool_(), pa.int64())))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((*keys, *lists), kinds)], names=names)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts = [], []
            for part in batch.column(0):
                parts = part.as_py()
                row, start, single, value = (
                    np.array([entry for p in parts for entry in p[name]]) for name in ("rows", "starts", "single", "hashes")
                )
                _, place, count = np.unique(value, return_inverse=True, return_counts=True)
                hit = (count[place] > 1) & single
                order = np.lexsort((start[hit], row[hit]))
                row, start = row[hit][order], start[hit][order]
                if len(row):
                    cuts = np.flatnonzero(np.diff(row)) + 1
                    rows += row[np.concatenate([[0], cuts])].tolist()
                    starts += np.split(start, cuts)
            yield run_batch(rows, starts)

    names = [column.split()[0] for column in PARTS.split(", ")]
    dealt = segments.select("name", "_row", "n", "n_forms", "first", "data").mapInArrow(deal, PARTS)
    lists = dealt.groupBy("name", "offset", "share").agg(F.collect_list(F.struct(*names[3:])).alias("parts"))
    return lists.select("parts").mapInArrow(find, RUNS)


def repeats(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """Each row with ``_row``, ``_id``, its ``packed`` text and ``windows``: first and last starts of repeated strings."""
    rows = saved(cut(docs, id_column, text, length, gram), "segments")
    zipped = F.arrays_zip("names", "forms", "firsts", "lasts")
    segments = rows.select("_row", F.explode(zipped).alias("s")).select(
        "_row", F.col("s.names").alias("name"), F.col("s.forms").alias("form"),
        F.col("s.firsts").alias("first"), F.col("s.lasts").alias("last"),
    )
    counts = segments.groupBy("name").agg(F.count(F.lit(1)).alias("_n"))
    common = saved(counts.filter("_n > 1").select("name"), "names")  # so that the join can split a hot name
    shared = saved(segments.join(common, "name", "left_semi"), "shared")
    forms = saved(
        shared.groupBy("name", "form").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("_row", "first", "last")).alias("one")
        ),
        "forms",
    )
    several = forms.groupBy("name").agg(F.count(F.lit(1)).alias("n_forms")).filter("n_forms > 1")
    listed = (
        forms.join(several, "name")
        .select("one._row", F.struct("name", "form", "n", "n_forms", "one.first", "one.last").alias("s"))
        .groupBy("_row")
        .agg(F.collect_list("s").alias("listed"))
    )
    at_edges = saved(edge_segments(rows.select("_row", "packed").join(listed, "_row"), length), "edges")
    starts = in_small_names(at_edges.filter(F.col("n_forms") <= FORMS), length, gram).unionByName(
        in_large_names(at_edges.filter(F.col("n_forms") > FORMS), length, gram)
    )
    whole = shared.join(forms.filter("n > 1").select("name", "form"), ["name", "form"], "left_semi")
    covered = (
        whole.select("_row", "first", "last")
        .unionByName(starts)
        .groupBy("_row")
        .agg(F.collect_list(F.struct("first", "last")).alias("windows"))
    )
    return rows.select("_row", "_id", "packed").join(saved(covered, "covered"), "_row", "left")


def remaining(data: bytes, windows: list[dict], length: int) -> tuple[bytes, int]:
    """The bytes that no window covers, and the number of maximal runs removed."""
    if not windows:
        return data, 0
    change = np.zeros(len(data) + 1, np.int32)
    np.add.at(change, [w["first"] for w in windows], 1)
    np.add.at(change, [w["last"] + length for w in windows], -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), runs


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """``id_column``, ``kept`` (the bytes left), ``n_bytes``, ``n_removed`` and ``n_spans`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdDecompressor()
        for batch in batches:
            for part, windows in sliced_lists(batch):
                kept, sizes, counts = [], [], []
                for packed, found in zip(part.column(1), windows):
                    data = packer.decompress(packed.as_py())
                    left, runs = remaining(data, found, length)
                    kept.append(left)
                    sizes.append(len(data))
                    counts.append(runs)
                removed = [size - len(left) for size, left in zip(sizes, kept)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()),
                     pa.array(removed, pa.int64()), pa.array(counts, pa.int64())], names=names,
                )

    names = [id_column, "kept", "n_bytes", "n_removed", "n_spans"]
    kind = docs.schema[id_column].dataType.simpleString()
    found = repeats(docs, id_column, text, length, gram).select("_id", "packed", "windows")
    schema = f"`{id_column}` {kind}, kept binary, n_bytes long, n_removed long, n_spans long"
    return found.mapInArrow(run, schema)


def sliced_lists(batch: pa.RecordBatch, rows: int = 256) -> Iterator[tuple[pa.RecordBatch, list]]:
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        yield part, part.column(part.num_columns - 1).to_pylist()
