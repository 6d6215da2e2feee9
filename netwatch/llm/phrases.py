"""Phrase collocations: windows of the longest phrases are counted, and a rollup gives all shorter ones.

A text is cut into pieces at punctuation and line ends, a piece into words. Each word opens one window: its
own column and a lead column for each further word of the longest phrase, NULL beyond the end of the piece. Windows are
counted once; the sums of a rollup over their columns then give ever shorter prefixes, so that words, pairs and longer
phrases, and the words of a language in all, come from one grouping instead of one explosion of n-grams each. The
rollup's keys are prefixes: a prefix names all words before its last one, so one key column for each length is
enough, and the lengths that a padded window lacks fall into one group instead of one for each window.

Most phrases are rare. So that these do not travel, a first pass counts the phrases of each length under hashed
slots. A slot holds at least the count of each phrase in it; where it stays under ``fewest``, no phrase of it can be
part of a candidate, and the second pass pads the window from there on. That loses no count that is used: parts of candidates
are as frequent as the candidate, and windows without a frequent word still count for their language. Slots are as many as
the input has bytes over ``BYTES_A_SLOT``, between the two bounds of ``SLOT_BITS``. What goes to all tasks is one bit per slot
and length, at most 64 MB a length whatever the input. Beyond that bound slots fill up and more windows travel; the
results are the same.

Counts are added up in the tasks before the shuffle (windows by slice of texts, prefixes by Spark). Scores are whole
numbers of exact decimals. The best phrases of a language are ranked inside shares first, one for each task.

Defined results: NULL and empty texts have no words, and a language without words no rows. A NULL language is
``und``, as is a language of that name. Rows with equal ids or texts count each; ids are not used. Bytes that
are no UTF-8 are part of words as they are.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netwatch.llm.tasks import discard, saved, sliced, texts

LONGEST = 3
FEWEST = 10
# A candidate goes if a longer one around it has this share of its occurrences, in hundredths.
SHARE = 50
TOP = 2_000
SCALE = 1_000_000

BYTES_A_SLOT = 6
SLOT_BITS = (20, 29)
# Slots of a length are added up in this many parts, powers of two.
PART_BITS = 9
GROUPS = 32
SLICE = 4 << 20

# The bytes that end a piece, as a line end; A-Z become a-z by bytes.lower. The split of bytes at
# white space then leaves words of anything but blanks and tabs, as all other white space ends a piece.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
AT_LINES = bytes(0x0A if b in PIECE_ENDS else b for b in range(256))

MIX = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of some texts as numbers, and how many words each one's piece still holds."""

    def __init__(self, values: list[bytes]) -> None:
        pieces = [piece.split() for piece in b"\n".join(values).lower().translate(AT_LINES).split(b"\n")]
        numbers: dict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        self.ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(pieces)), np.int64)
        self.distinct = list(numbers)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(self.ids))

    def slots(self, lang: str, longest: int, bits: int) -> list[np.ndarray]:
        """For each length, the slot of the phrase that each word begins.

        Where a piece ends before, the slot means nothing.
        """
        seed = xxhash.xxh3_64_intdigest(lang)
        digest = xxhash.xxh3_64_intdigest
        each = np.fromiter((digest(word, seed) for word in self.distinct), np.uint64, len(self.distinct))[self.ids]
        out, so_far = [], each.copy()
        for n in range(1, longest + 1):
            if n > 1:
                so_far[: len(each) - n + 1] = so_far[: len(each) - n + 1] * MIX + each[n - 1 :]
            mixed = (so_far ^ (so_far >> np.uint64(31))) * MIX
            out.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
        return out


def by_language(part: pa.RecordBatch, values: list) -> Iterator[tuple[str, Words]]:
    """The texts of each language of a slice; the language is the column before the text."""
    groups: dict[str, list[bytes]] = defaultdict(list)
    for lang, value in zip(part.column(part.num_columns - 2).to_pylist(), values):
        if value:
            groups[lang].append(value)
    for lang, found in groups.items():
        if len((words := Words(found)).ids):
            yield lang, words


def packed(slots: np.ndarray, counts: np.ndarray, packer: zstandard.ZstdCompressor) -> bytes:
    """Rising slots as steps of two bytes, all low ones first, and their counts up to 255.

    A step too long is cut by slots that count nothing.
    """
    steps = np.diff(slots, prepend=0)
    cuts = steps // 65_535
    if cuts.any():
        ends = np.cumsum(cuts + 1) - 1
        filled, counted = np.full(ends[-1] + 1, 65_535), np.zeros(ends[-1] + 1, np.int64)
        filled[ends], counted[ends] = steps % 65_535, counts
        steps, counts = filled, counted
    planes = np.stack([steps & 0xFF, steps >> 8, np.minimum(counts, 255)]).astype(np.uint8)
    return packer.compress(planes.tobytes())


def unpacked(cell: bytes, packer: zstandard.ZstdDecompressor) -> tuple[np.ndarray, np.ndarray]:
    low, high, counts = np.frombuffer(packer.decompress(cell), np.uint8).reshape(3, -1)
    return np.cumsum(low + (high.astype(np.int64) << 8)), counts


def counted_slots(longest: int, bits: int):
    """A row for each length and part of the slots, with the slots of a slice in it: as many rows for each slice."""
    names = ["length", "part", "packed"]
    kinds = (pa.int32(), pa.int32(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(1)
        for batch in batches:
            for rows, values in sliced(batch, SLICE):
                slots: list[list[np.ndarray]] = [[] for _ in range(longest)]
                for lang, words in by_language(rows, values):
                    for n, found in enumerate(words.slots(lang, longest, bits)):
                        slots[n].append(found[words.left > n])
                cells: list[tuple[int, int, bytes]] = []
                for n, found in enumerate(slots, 1):
                    own, counts = np.unique(np.concatenate(found or [np.zeros(0, np.int64)]), return_counts=True)
                    shift = bits - PART_BITS
                    parts, starts = np.unique(own >> shift, return_index=True)
                    for part, a, b in zip(parts.tolist(), starts, [*starts[1:], len(own)]):
                        cells.append((n, part, packed(own[a:b] - (part << shift), counts[a:b], packer)))
                columns = list(zip(*cells)) or [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def full_slots(fewest: int, bits: int):
    """Adds up the parts of a partition, up to 255 a slot, and gives the slots that reach ``fewest`` as bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdDecompressor()
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for n, part, cell in zip(*(column.to_pylist() for column in batch.columns)):
                if (n, part) not in held:
                    held[n, part] = np.zeros(1 << (bits - PART_BITS), np.uint8)
                sums = held[n, part]
                at, counts = unpacked(cell, packer)
                sums[at] = np.minimum(sums[at].astype(np.uint16) + counts, 255)
        for (n, part), sums in held.items():
            full = np.packbits(sums >= min(fewest, 255))
            if full.any():
                yield pa.RecordBatch.from_pydict(
                    {"length": pa.array([n], pa.int32()), "part": pa.array([part], pa.int32()),
                     "full": pa.array([full.tobytes()], pa.binary())}
                )

    return run


def slot_bits(n_bytes: int) -> int:
    least, most = SLOT_BITS
    return min(most, max(least, (n_bytes // BYTES_A_SLOT).bit_length()))


def windows(frame: DataFrame, longest: int, fewest: int, bits: int) -> DataFrame:
    """``lang``, ``w1`` and the lead columns to ``longest``, and ``n``, how often a slice holds the window.

    ``frame`` holds a language and the text as bytes.
    """
    parts = frame.mapInArrow(counted_slots(longest, bits), "length int, part int, packed binary")
    dealt = parts.repartition("length", "part")
    # Written first, so that the counts of the slots leave the disks before the windows come.
    found = saved(dealt.mapInArrow(full_slots(fewest, bits), "length int, part int, full binary"), "slots")
    rows = found.collect()  # at most a bit per slot and length
    discard(found)
    full = {n: np.zeros(1 << (bits - 3), np.uint8) for n in range(1, longest + 1)}
    size = 1 << (bits - PART_BITS - 3)
    for row in rows:
        full[row.length][row.part * size : (row.part + 1) * size] = np.frombuffer(row.full, np.uint8)
    shared = frame.sparkSession.sparkContext.broadcast(full)
    names = [f"w{n}" for n in range(1, longest + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = shared.value
        for batch in batches:
            for part, values in sliced(batch, SLICE):
                for lang, words in by_language(part, values):
                    columns = padded(words, words.slots(lang, longest, bits), full)
                    at, counts = distinct_rows(columns, len(words.distinct) + 1)
                    spelled = pa.array(words.distinct, pa.binary())
                    cells = [spelled.take(pa.array(c[at], mask=c[at] < 0)) for c in columns]
                    head = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(at), np.int32)))
                    yield pa.RecordBatch.from_arrays([head, *cells, pa.array(counts)], names=["lang", *names, "n"])

    schema = ", ".join(f"{name} binary" for name in names)
    found = frame.mapInArrow(run, f"lang string, {schema}, n long")
    return found.select("lang", *(F.col(name).cast("string").alias(name) for name in names), "n")


def padded(words: Words, slots: list[np.ndarray], full: dict[int, np.ndarray]) -> list[np.ndarray]:
    """The window columns of each word, -1 beyond the piece and from the first length on that cannot be frequent."""
    columns, before = [], np.ones(len(words.ids), bool)
    for n, slot in enumerate(slots, 1):
        able = (words.left >= n) & ((full[n][slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1).astype(bool)
        able &= before
        if n > 1:
            able[:-1] &= before[1:]  # the phrase without its first word
        lead = np.full(len(words.ids), -1)
        lead[: max(0, len(lead) - n + 1)] = words.ids[n - 1 :]
        columns.append(np.where(able, lead, -1))
        before = able
    return columns


def distinct_rows(columns: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different row, and how often it occurs. Cells are from -1 to ``size`` - 2."""
    code, most = columns[0] + 1, size
    for column in columns[1:]:
        if most > (1 << 62) // size:
            code = np.unique(code, return_inverse=True)[1]
            most = len(code) + 1
        code = code * size + (column + 1)
        most *= size
    _, at, counts = np.unique(code, return_index=True, return_counts=True)
    return at, counts


def phrase_counts(found: DataFrame, longest: int, fewest: int) -> DataFrame:
    """``lang``, ``length``, ``phrase`` and ``f`` of all phrases that occur ``fewest`` times; length 0 has a language's words."""
    names = [f"w{n}" for n in range(1, longest + 1)]
    # A prefix is NULL as soon as one of its words is.
    prefixes = [F.concat(F.col("w1"), *(x for name in names[1:n] for x in (F.lit(" "), F.col(name)))) for n in range(1, longest + 1)]
    keyed = found.select("lang", "n", *(prefix.alias(f"p{n}") for n, prefix in enumerate(prefixes, 1)))
    keys = [f"p{n}" for n in range(1, longest + 1)]
    rolled = keyed.groupingSets([["lang"], *(["lang", key] for key in keys)], "lang", *keys)
    sums = rolled.agg(F.sum("n").alias("f"), F.grouping_id().alias("_set"))
    # The number of a grouping set has ones for the keys that it sums over.
    every = (1 << longest) - 1
    length = F.when(F.col("_set") == every, 0)
    for n in range(1, longest + 1):
        length = length.when((F.col("_set") == every - (1 << (longest - n))) & F.col(f"p{n}").isNotNull(), n)
    rows = sums.select("lang", length.alias("length"), F.coalesce(*keys, F.lit("")).alias("phrase"), "f")
    return rows.filter((F.col("length") == 0) | (F.col("length").isNotNull() & (F.col("f") >= fewest)))


def scored(counts: DataFrame) -> DataFrame:
    """Each candidate with the counts of its lowest-scoring cut."""
    candidates = counts.filter("length > 1").select("lang", "length", "phrase", F.col("f").alias("a"))
    words = F.split("phrase", " ")
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k")).select(
        "*",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("_left"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("length") - F.col("k")), " ").alias("_right"),
    )
    parts = counts.filter("length > 0")
    lefts = parts.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l"))
    rights = parts.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r"))
    both = cuts.join(lefts, ["lang", "_left"]).join(rights, ["lang", "_right"])
    exact = {name: f"CAST({name} AS DECIMAL(19, 0))" for name in "alr"}
    score = F.expr(f"(CAST({SCALE} AS DECIMAL(7, 0)) * {exact['a']} * {exact['a']}) div ({exact['l']} * {exact['r']})")
    lowest = both.groupBy("lang", "length", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_cut"))
    return lowest.select("lang", "length", "phrase", "a", "_cut.score", "_cut.l", "_cut.r")


def around(counts: DataFrame) -> DataFrame:
    """For each phrase inside a longer candidate, ``longer``, the most occurrences of such a one."""
    words = F.split("phrase", " ")
    n = F.col("length")
    inside = F.flatten(
        F.transform(
            F.sequence(F.lit(2), n - 1),
            lambda size: F.transform(F.sequence(F.lit(1), n - size + 1), lambda at: F.array_join(F.slice(words, at, size), " ")),
        )
    )
    parts = counts.filter("length > 2").select("lang", "f", F.explode(inside).alias("phrase"))
    return parts.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    longest: int = LONGEST,
    fewest: int = FEWEST,
    share: int = SHARE,
    top: int = TOP,
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    frame = texts(docs, F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("_lang"), text=text)
    n_bytes = frame.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    found = windows(frame, longest, fewest, slot_bits(n_bytes))
    counts = saved(phrase_counts(found, longest, fewest), "phrases")
    rows = scored(counts).join(around(counts), ["lang", "phrase"], "left")
    own = rows.filter(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = own.withColumn("_share", F.spark_partition_id())
    for share_of in ("_share", F.col("_share") % GROUPS):  # a language is never ranked as a whole in one task
        inside = Window.partitionBy("lang", share_of).orderBy(*order)
        some = some.withColumn("_rank", F.row_number().over(inside)).filter(F.col("_rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    totals = counts.filter("length = 0").select("lang", F.col("f").alias("n"))
    best = ranked.filter(F.col("rank") <= top).join(totals, "lang")
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
