"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is a sequence of tokens: its words, then one end. Words are spelled by bytes and a closing byte, bits
from the highest down, and each bit of each word, known or new, is predicted by logistic mixing in two layers (``Mixer``).
In the first, predictors look up what followed the same context (place in the word, the last 1, 2, 3 or 5 bytes)
in tables of hashed contexts. Their log odds are summed with weights that a gate selects (the longest context seen
before, and the bit's place), and a table refines the sum by what came true at such sums. The last layer mixes
this with what followed the word's beginning, all of its bytes so far, in all languages and in one language; each
leaves what a discount frees to the one before it, and its gate is how often the beginning was seen in both. So a word's
price by language follows from bits alone, and prices of all words sum to one.

Tables count every occurrence in training rows, and weights are learned online from every occurrence, which is itself left
out of the counts meanwhile. Beginnings from ``LOCAL`` bytes on are counted exactly, without hashed slots, however many
there are: words are dealt to buckets by their first ``LOCAL`` bytes, so all words with such a beginning are in one. Contexts end
where a word begins; beyond it a token depends on its language and the tokens of its text.
Last, the text itself is a context. With a weight that grows to ``RECENT_MOST`` as its tokens go by, a token has
the share that it had among the tokens before it.

The text's probability is the sum over languages of share times product. Languages are those of the
training rows; a scored row gives nothing but its text.

How it runs: a task cuts its rows into batches of about ``BATCH_BYTES`` and counts each batch's words once;
words are dealt to buckets, so many as there are batches. Buckets sum the counts of
all batches, answer each batch with counts and prices of its words, and batches price their texts with the
answers. No row per token is made. Tables have a fixed size, ``TABLE_BITS`` and ``SHORT_BITS``; they and the weights are all that goes to every task.

Defined results: NULL texts are empty and have the end only. Without training rows nothing is known, the
base is 0 per token, and words that are new to their text are worth one half per bit. NULL languages are one language more. Equal
rows get equal scores. Sums are in double precision, in the order of a text's words.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netwatch.llm.repeats import BASE, INVERSE, powers
from netwatch.llm.tasks import saved, sliced, texts

BATCH_BYTES = 16 << 20
# Slots of each hashed predictor, as powers of two: place, last 1, 2, 3, 5 bytes.
TABLE_BITS = (12, 16, 18, 19, 20)
# Words are dealt by so many first bytes, so that longer beginnings are counted exactly in one bucket.
LOCAL = 4
# Slots of shorter beginnings, as a power of two, all languages together.
SHORT_BITS = 21
PIECE_BITS = 17
DISCOUNT = 0.75
PRIOR = 0.4
# The greatest weight of the tokens before in a text, and how many of them give half of it.
RECENT_MOST, RECENT_HALF = 0.05, 20
TOKENS_AT_ONCE = 65_536
RATE = 0.02
LEVELS = 24
# The least probability of a bit.
LEAST = np.float32(1e-6)
# Levels of how often a beginning was seen.
OFTEN = 8
WORDS_AT_ONCE, BYTES_AT_ONCE = 4_096, 1 << 16
# Most languages with prices of their own; more share the last one.
MOST_LANGS = 64

MIX = np.uint64(0x9E3779B97F4A7C15)
INPUTS = len(TABLE_BITS) + 1
GATES = (len(TABLE_BITS) + 1) * 8
LAST_GATES, LAST_INPUTS = OFTEN * OFTEN * 8, 3


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


class Spelling(NamedTuple):
    """Words laid out as bytes: a hash per predictor and byte, that of the beginning, the byte itself, its place and word."""

    contexts: list[np.ndarray]
    prefix: np.ndarray
    codes: np.ndarray
    depth: np.ndarray
    of: np.ndarray
    starts: np.ndarray

    def at(self, places: np.ndarray) -> Spelling:
        """Only the bytes at these places."""
        return Spelling([c[places] for c in self.contexts], *(a[places] for a in self[1:5]), self.starts)


class Beginnings:
    """The bytes of a spelling in an order that brings those with the same beginning and the same next bits together.

    Words that begin alike share contexts, slots and counts, so these are looked up once a beginning.
    """

    def __init__(self, spelled: Spelling) -> None:
        names, node = np.unique(spelled.prefix, return_inverse=True)
        coded = (node.astype(np.int64) << 8) | spelled.codes.astype(np.int64)
        self.order = np.argsort(coded)
        self.coded = coded[self.order]

    def runs(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the runs of bytes start that share their beginning and ``bits`` bits, and the run of each byte."""
        part = self.coded >> (8 - bits)
        first = np.concatenate([np.ones(min(1, len(part)), bool), part[1:] != part[:-1]])
        return np.flatnonzero(first), np.cumsum(first) - 1


def spelling(words: list[bytes]) -> Spelling:
    text = b"".join(word + b" " for word in words)
    codes = np.frombuffer(text, np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.cumsum(lengths) - lengths
    begin = np.repeat(starts, lengths)
    depth = np.arange(len(codes)) - begin
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(1)) * powers(BASE, len(codes)))])
    prefix = (sums[:-1] - sums[begin]) * powers(INVERSE, len(codes))[begin]
    last = np.zeros(len(codes), np.uint64)
    suffixes = {}
    for n in range(1, 6):
        back = np.zeros(len(codes), np.uint64)
        back[n:] = codes[:-n]
        last = last * np.uint64(257) + np.where(depth >= n, back + np.uint64(1), 0).astype(np.uint64)
        suffixes[n] = last
    place = np.minimum(depth, 15).astype(np.uint64)
    contexts = [place, suffixes[1], suffixes[2], suffixes[3], suffixes[5]]
    hashed = [(c + np.uint64(i + 1)) * MIX for i, c in enumerate(contexts)]
    beginning = (prefix ^ (depth.astype(np.uint64) << np.uint64(48))) * MIX
    return Spelling(hashed, beginning, codes, depth, np.repeat(np.arange(len(words)), lengths), starts)


def slots(spelled: Spelling, bit: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The slot of each hashed predictor at a bit of every byte, the hash of beginning and bits, and the bit."""
    part = ((np.uint64(0x100) | spelled.codes) >> np.uint64(8 - bit)) * np.uint64(0xBF58476D1CE4E5B9)
    value = ((spelled.codes >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64)

    def mixed(context: np.ndarray) -> np.ndarray:
        out = (context ^ (context >> np.uint64(29))) + part
        return (out ^ (out >> np.uint64(32))) * MIX

    found = [(mixed(c) >> np.uint64(64 - size)).astype(np.int64) for c, size in zip(spelled.contexts, TABLE_BITS)]
    return found, mixed(spelled.prefix), value


class Tables:
    """How often a 0 and a 1 followed each slot: of hashed contexts, and of short beginnings by language."""

    def __init__(self, width: int) -> None:
        self.width, self.short_bits = width, SHORT_BITS - (width - 1).bit_length()
        self.counts = [np.zeros((1 << size, 2), np.float32) for size in TABLE_BITS]
        self.counts.append(np.zeros((width << self.short_bits, 2), np.float32))

    def short(self, key: np.ndarray, lang: int) -> np.ndarray:
        return (key >> np.uint64(64 - self.short_bits)).astype(np.int64) * self.width + lang

    def learn(self, words: list[bytes], counts: np.ndarray) -> None:
        """Each word as often as it occurs in training rows."""
        spelled = spelling(words)
        each = counts.T.astype(np.float32)[:, spelled.of]
        times = each.sum(axis=0)
        begins = spelled.depth < LOCAL
        for bit in range(8):
            found, key, value = slots(spelled, bit)
            for table, slot in zip(self.counts, found):
                np.add.at(table.reshape(-1), 2 * slot + value, times)
            for lang in range(self.width):
                here = np.flatnonzero(begins & (each[lang] > 0))
                np.add.at(self.counts[-1].reshape(-1), 2 * self.short(key[here], lang) + value[here], each[lang, here])

    def followed(self, spelled: Spelling, key: np.ndarray, local: np.ndarray) -> np.ndarray:
        """By language, how often a 0 and a 1 followed each beginning, given here by one of its bytes.

        ``local`` counts the words at hand, which are all with their first ``LOCAL`` bytes.
        """
        out = local.astype(np.float32)
        begins = np.flatnonzero(spelled.depth < LOCAL)
        rows = self.counts[-1].reshape(-1, self.width, 2)[(key[begins] >> np.uint64(64 - self.short_bits)).astype(np.int64)]
        out[:, begins] = rows.transpose(1, 0, 2)
        return out

    def hashed_odds(self) -> list[np.ndarray]:
        """The log odds of each slot of hashed contexts, NaN where nothing was seen."""
        return [np.where(table.any(axis=1), log_odds(*table.T), np.float32(np.nan)) for table in self.counts[:-1]]

    def pieces(self) -> Iterator[tuple[int, int, bytes]]:
        packer = zstandard.ZstdCompressor(1)
        for number, table in enumerate(self.counts):
            flat = table.reshape(-1)
            for at in range(0, len(flat), 1 << PIECE_BITS):
                if (part := flat[at : at + (1 << PIECE_BITS)]).any():
                    yield number, at, packer.compress(part.tobytes())

    def put(self, number: int, at: int, packed: bytes) -> None:
        part = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.float32)
        self.counts[number].reshape(-1)[at : at + len(part)] += part


def log_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR)))


def often(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(n)[1], OFTEN - 1)


def backed_off(zeros: np.ndarray, ones: np.ndarray, coarser: np.ndarray) -> np.ndarray:
    """The probability of a 1, what a discount frees being left to a coarser one."""
    n = zeros + ones
    freed = np.float32(DISCOUNT) * ((zeros > 0).astype(np.float32) + (ones > 0))
    p = (np.maximum(ones - np.float32(DISCOUNT), 0) + freed * coarser) / np.maximum(n, 1)
    return np.where(n > 0, p, coarser)


def stretched(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, LEAST, 1 - LEAST)
    return np.log(p / (1 - p))


class Mixer:
    """Weights by gate, in two layers, and the refining table by gate and level of the log odds.

    The first layer mixes the hashed contexts; its gate is the longest one seen. The last layer mixes its result with what
    followed the beginning in all languages and in one; its gate is how often these were seen.
    """

    def __init__(self) -> None:
        self.weights = np.full((GATES, INPUTS), 0.3)
        self.weights[:, -1] = 0
        self.last = np.zeros((OFTEN, OFTEN, 8, LAST_INPUTS))
        self.last[0, ..., 1] = 1
        self.last[1:, ..., 2] = 1
        self.last = self.last.reshape(LAST_GATES, LAST_INPUTS)
        self.seen = np.zeros((GATES, LEVELS, 2))
        self.steps, self.last_steps = np.full(self.weights.shape, 1e-8), np.full(self.last.shape, 1e-8)

    def odds(self, held: list[np.ndarray], found: list[np.ndarray], bit: int, value: np.ndarray | None = None):
        """Inputs, log odds and gate of the first layer, from ``hashed_odds``. With ``value``, from counts, that occurrence left out."""
        inputs = np.empty((INPUTS, len(found[0])), np.float32)
        inputs[-1] = 0.3
        longest = np.zeros(len(found[0]), np.int64)
        for number, (table, slot) in enumerate(zip(held, found)):
            if value is None:
                inputs[number] = table.take(slot)
                seen = ~np.isnan(inputs[number])
                inputs[number, ~seen] = 0
            else:
                zeros, ones = table.take(slot, axis=0).T
                zeros, ones = np.maximum(zeros - (1 - value), 0), np.maximum(ones - value, 0)
                inputs[number], seen = log_odds(zeros, ones), (zeros + ones) > 0
            longest[seen] = number + 1
        gate = longest * 8 + bit
        return inputs, sum(self.weights[:, i].astype(np.float32).take(gate) * x for i, x in enumerate(inputs)), gate

    def refined(self) -> tuple[np.ndarray, np.ndarray]:
        total = self.seen.sum(axis=2)
        return ((self.seen[:, :, 1] + PRIOR) / (total + 2 * PRIOR)).astype(np.float32), total > 100

    def first(self, odds: np.ndarray, gate: np.ndarray, refined: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        p, at = squashed(odds), level(odds)
        p = np.where(refined[1][gate, at], (p + refined[0][gate, at]) / 2, p)
        return np.clip(p, np.float32(1e-5), np.float32(1 - 1e-5))

    def final(self, inputs: tuple[np.ndarray, ...], n_lang: np.ndarray | int, n_all: np.ndarray, bit: int):
        """Probability and gate of the last layer; its inputs are log odds of the first, of all languages and of one."""
        gate = (often(n_lang) * OFTEN + often(n_all)) * 8 + bit
        odds = sum(self.last[:, i].astype(np.float32).take(gate) * x for i, x in enumerate(inputs))
        return np.clip(squashed(odds), LEAST, 1 - LEAST), gate

    def learn(self, tables: Tables, words: list[bytes], counts: np.ndarray) -> None:
        """One step per bit over a block of words, each as often as it occurs, the occurrence itself left out."""
        spelled, refined = spelling(words), self.refined()
        begun = Beginnings(spelled)
        each = counts.T.astype(np.float64)[:, spelled.of[begun.order]]
        for bit in range(8):
            # Bytes with one beginning and one bit after it are one step, as often as they occur together.
            starts, _ = begun.runs(bit + 1)
            own, times_each = spelled.at(begun.order[starts]), np.add.reduceat(each, starts, axis=1)
            times = times_each.sum(axis=0)
            found, key, value = slots(own, bit)
            inputs, odds, gate = self.odds(tables.counts, found, bit, value.astype(np.float32))
            first = self.first(odds, gate, refined)
            part = begun.coded[starts] >> (8 - bit)
            run = np.cumsum(np.concatenate([[False], part[1:] != part[:-1]]))
            local = np.zeros((tables.width, run[-1] + 1, 2))
            local[:, run, value] = times_each
            followed = tables.followed(own, key, local[:, run])
            zeros = np.maximum(followed[..., 0].sum(axis=0) - (1 - value), 0)
            ones = np.maximum(followed[..., 1].sum(axis=0) - value, 0)
            both = backed_off(zeros, ones, first)
            coarse = stretched(first), stretched(both)
            for lang in range(tables.width):
                here = np.flatnonzero(times_each[lang])
                if not len(here):
                    continue
                own_zeros, own_ones = followed[lang, here].T
                own_zeros, own_ones = np.maximum(own_zeros - (1 - value[here]), 0), np.maximum(own_ones - value[here], 0)
                of_lang = backed_off(own_zeros, own_ones, both[here])
                last = coarse[0][here], coarse[1][here], stretched(of_lang)
                p, at = self.final(last, own_zeros + own_ones, (zeros + ones)[here], bit)
                step(self.last, self.last_steps, last, value[here] - p, times_each[lang, here], at)
            self.seen += np.bincount((gate * LEVELS + level(odds)) * 2 + value, times, self.seen.size).reshape(self.seen.shape)
            step(self.weights, self.steps, inputs, value - squashed(odds), times, gate)

    def log10(self, tables: Tables, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """log10 of the probability of each word by language; ``counts`` of the words in training rows."""
        out, refined, held = [np.empty((0, tables.width))], self.refined(), tables.hashed_odds()
        for part in blocks(words):
            spelled = spelling(words[part])
            begun = Beginnings(spelled)
            each = counts[part].T.astype(np.float64)[:, spelled.of[begun.order]]
            byte = np.ones((tables.width, len(spelled.codes)))
            for bit in range(8):
                starts, run = begun.runs(bit)
                own = spelled.at(begun.order[starts])
                found, key, _ = slots(own, bit)
                _, odds, gate = self.odds(held, found, bit)
                first = self.first(odds, gate, refined)
                place = 2 * run + (begun.coded >> (7 - bit) & 1)
                local = np.stack([np.bincount(place, one, 2 * len(starts)) for one in each]).reshape(tables.width, -1, 2)
                followed = tables.followed(own, key, local)
                zeros, ones = followed.sum(axis=0).T
                n, both = zeros + ones, backed_off(zeros, ones, first)
                coarse = stretched(first), stretched(both)
                unseen, _ = self.final((*coarse, coarse[1]), np.zeros_like(n), n, bit)
                for lang in range(tables.width):
                    here = np.flatnonzero(followed[lang].any(axis=1))
                    own_zeros, own_ones = followed[lang, here].T
                    last = coarse[0][here], coarse[1][here], stretched(backed_off(own_zeros, own_ones, both[here]))
                    p = unseen.copy()
                    p[here], _ = self.final(last, own_zeros + own_ones, n[here], bit)
                    byte[lang] *= np.stack([1 - p, p], axis=1).reshape(-1).take(place)
            logs = np.empty_like(byte)
            logs[:, begun.order] = np.log10(byte)
            out.append(np.add.reduceat(logs, spelled.starts, axis=1).T)
        return np.concatenate(out)


def step(weights: np.ndarray, steps: np.ndarray, inputs: np.ndarray, error: np.ndarray, times: np.ndarray, gate: np.ndarray) -> None:
    """One step of each gate's weights along the mean gradient, the shorter the more steps were made."""
    total = np.maximum(np.bincount(gate, times, len(weights)), 1)
    for i, values in enumerate(inputs):
        slope = np.bincount(gate, values * error * times, len(weights)) / total
        steps[:, i] += slope**2
        weights[:, i] += RATE * slope / np.sqrt(steps[:, i])


def squashed(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -15, 15)))


def level(odds: np.ndarray) -> np.ndarray:
    return np.clip((odds + 12) * (LEVELS / 24), 0, LEVELS - 1).astype(np.int64)


def packed_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(1).compress(b" ".join(words))


def packed_array(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(values).tobytes())


def unpacked(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def unpacked_words(packed: bytes) -> list[bytes]:
    """The end, as the empty word, can only be first."""
    return unpacked(packed).split(b" ")


BATCHES = "batch long, held boolean, packed binary, bucket int, words binary, counts binary, langs int"


def counted(docs: DataFrame, held: Column, lang: str | None, langs: list, buckets: int, id_column: str, text: str) -> DataFrame:
    """Rows of two kinds: texts with their batch, and by batch and bucket its words with counts per language."""
    places = {name: min(i, MOST_LANGS - 1) for i, name in enumerate(langs)}
    width = max(1, min(len(langs), MOST_LANGS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 33
        number, size = 0, 0
        counters: dict[int, Counter] = defaultdict(Counter)
        packer = zstandard.ZstdCompressor(1)
        for batch in batches:
            for part, values in sliced(batch):
                flags = part.column(1).to_pylist()
                names = part.column(2).to_pylist()
                for value, out, name in zip(values, flags, names):
                    words = words_of(value)
                    words.append(b"")
                    counters[-1 if out else places.get(name, width - 1)].update(words)
                    size += len(value or b"")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([task + number] * len(values), pa.int64()), part.column(1),
                     pa.array([packer.compress(v or b"") for v in values], pa.binary()),
                     *(pa.nulls(len(values), k) for k in (pa.int32(), pa.binary(), pa.binary(), pa.int32()))],
                    names=columns,
                )
                if size >= BATCH_BYTES:
                    yield dealt(task + number, counters)
                    number, size, counters = number + 1, 0, defaultdict(Counter)
        yield dealt(task + number, counters)

    def dealt(batch: int, counters: dict[int, Counter]) -> pa.RecordBatch:
        words = sorted(set().union(*counters.values()))
        table = np.zeros((len(words), width), np.int32)
        for place, counter in counters.items():
            if place >= 0:
                table[:, place] = np.fromiter(map(counter.get, words, repeat(0)), np.int64, len(words))
        bucket = np.fromiter((xxhash.xxh32_intdigest(w[:LOCAL]) % buckets for w in words), np.int64, len(words))
        rows: list[tuple] = []
        for one in np.unique(bucket).tolist():
            mine = np.flatnonzero(bucket == one)
            rows.append((one, packed_words([words[i] for i in mine]), packed_array(table[mine])))
        kinds = (pa.int32(), pa.binary(), pa.binary())
        arrays = [pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)] if rows else [pa.nulls(0, k) for k in kinds]
        count = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(count, pa.string()), pa.array([batch] * count, pa.int64()), pa.nulls(count, pa.bool_()),
             pa.nulls(count, pa.binary()), *arrays, pa.array([width] * count, pa.int32())], names=columns,
        )

    columns = ["_id", "batch", "held", "packed", "bucket", "words", "counts", "langs"]
    name = F.lit(None).cast("string") if lang is None else F.col(lang)
    frame = texts(docs, F.col(id_column).cast("string").alias("_id"), held.alias("_held"), name.alias("_lang"), text=text)
    return frame.mapInArrow(run, f"_id string, {BATCHES}")


def merged(rows: pd.DataFrame) -> pd.DataFrame:
    """The counts of a bucket's words, summed over batches; words in sorted order."""
    places: dict[bytes, int] = {}
    width = int(rows["langs"].iloc[0])
    parts = [(unpacked_words(w), np.frombuffer(unpacked(c), np.int32).reshape(-1, width)) for w, c in zip(rows["words"], rows["counts"])]
    for words, _ in parts:
        for word in words:
            places.setdefault(word, len(places))
    table = np.zeros((len(places), width), np.int64)
    for words, counts in parts:
        at = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
        table[at] += counts
    words = sorted(places)
    table = table[np.fromiter(map(places.__getitem__, words), np.int64, len(words))]
    return pd.DataFrame(
        {"bucket": [rows["bucket"].iloc[0]], "words": [packed_words(words)], "counts": [packed_array(table)], "langs": [width],
         "tokens": [int(table.sum())], "types": [int((table.sum(axis=1) > 0).sum())]}
    )


VOCABULARY = "bucket int, words binary, counts binary, langs int, tokens long, types long"


def blocks(words: list[bytes]) -> Iterator[slice]:
    """Runs of sorted words, those with the same first ``LOCAL`` bytes together, of ``WORDS_AT_ONCE`` or ``BYTES_AT_ONCE`` and more."""
    start, size = 0, 0
    for at, word in enumerate(words):
        if (at - start >= WORDS_AT_ONCE or size >= BYTES_AT_ONCE) and word[:LOCAL] != words[at - 1][:LOCAL]:
            yield slice(start, at)
            start, size = at, 0
        size += len(word) + 1
    if start < len(words):
        yield slice(start, len(words))


def known_blocks(packed: bytes, counts: bytes, width: int) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The words of a bucket that occur in training rows, and how often by language."""
    words = unpacked_words(packed)
    table = np.frombuffer(unpacked(counts), np.int64).reshape(-1, width)
    known = np.flatnonzero(table.any(axis=1))
    held, table = [words[i] for i in known.tolist()], table[known]
    for part in blocks(held):
        yield held[part], table[part]


def learned_tables(vocabulary: DataFrame, width: int) -> Tables:
    """The tables of all occurrences of all words: each task's own are cut into pieces, which are summed piece by piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(width)
        for batch in batches:
            for words, counts in zip(*(batch.column(i).to_pylist() for i in range(2))):
                for block, often_each in known_blocks(words, counts, width):
                    tables.learn(block, often_each)
        for number, at, packed in tables.pieces():
            yield pa.RecordBatch.from_pydict(
                {"number": pa.array([number], pa.int32()), "at": pa.array([at], pa.int32()), "packed": pa.array([packed], pa.binary())}
            )

    def summed(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(unpacked(p), np.float32).astype(np.float64) for p in rows["packed"])
        return rows.head(1).assign(packed=[packed_array(total.astype(np.float32))])

    schema = "number int, at int, packed binary"
    pieces = vocabulary.select("words", "counts").mapInArrow(run, schema)
    tables = Tables(width)
    for row in pieces.groupBy("number", "at").applyInPandas(summed, schema).collect():  # TABLE_BITS and SHORT_BITS bound it
        tables.put(row.number, row.at, row.packed)
    return tables


def spread_over(vocabulary: DataFrame) -> int:
    """As many tasks as there are buckets, up to twice the tasks that run at one time."""
    return max(1, min(vocabulary.count(), 2 * vocabulary.sparkSession.sparkContext.defaultParallelism))


def learned_mixer(vocabulary: DataFrame, tables, width: int) -> Mixer:
    """Each task learns online over the occurrences of its words; weights are averaged by the number of words, sightings summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, words_seen = Mixer(), 0
        for batch in batches:
            for words, counts in zip(*(batch.column(i).to_pylist() for i in range(2))):
                for block, often_each in known_blocks(words, counts, width):
                    mixer.learn(tables.value, block, often_each)
                    words_seen += len(block)
        if words_seen:
            yield pa.RecordBatch.from_pydict(
                {"n": pa.array([float(words_seen)]), "weights": pa.array([np.concatenate([mixer.weights.ravel(), mixer.last.ravel()]).tolist()]),
                 "seen": pa.array([mixer.seen.ravel().tolist()])}
            )

    spread = vocabulary.select("words", "counts").repartition(spread_over(vocabulary))
    # Written, as two sums read it: the learning itself runs once.
    rows = saved(spread.mapInArrow(run, "n double, weights array<double>, seen array<double>"), "mixers")
    parts = rows.select("n", F.posexplode("weights").alias("at", "w")).groupBy("at").agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w"))
    sightings = rows.select(F.posexplode("seen").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s"))
    both = saved(parts.select("at", "w", F.lit(None).cast("double").alias("s")).unionByName(sightings.select("at", F.lit(None).cast("double").alias("w"), "s")), "weights")
    mixer = Mixer()
    for row in both.collect():  # as many numbers as the two layers have weights, and GATES times LEVELS
        if row.w is not None:
            layer, at = (mixer.weights, row.at) if row.at < mixer.weights.size else (mixer.last, row.at - mixer.weights.size)
            layer.reshape(-1)[at] = row.w
        else:
            mixer.seen.reshape(-1)[row.at] = row.s
    return mixer


def base_log10(times: np.ndarray, all_tokens: int, all_types: int) -> np.ndarray:
    return np.log10((times + 0.1) / (all_tokens + 0.1 * (all_types + 1)))


def earlier(at: np.ndarray) -> np.ndarray:
    """How often each token occurs before its place."""
    order = np.argsort(at, kind="stable")
    grouped = at[order]
    first = np.flatnonzero(np.concatenate([[True], grouped[1:] != grouped[:-1]]))
    sizes = np.diff(np.concatenate([first, [len(at)]]))
    out = np.empty(len(at), np.int64)
    out[order] = np.arange(len(at)) - np.repeat(first, sizes)
    return out


def texts_log10(texts: list[np.ndarray], by_lang: np.ndarray, share: np.ndarray) -> np.ndarray:
    """log10 of the probability of each text, given the places of its tokens among the priced words.

    Several texts are at most ``TOKENS_AT_ONCE`` long in all; one alone may be longer.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(lengths) - lengths
    at, text = np.concatenate(texts), np.repeat(np.arange(len(texts)), lengths)
    seen, before = earlier(text * len(by_lang) + at), np.arange(len(at)) - starts[text]
    sums = np.zeros((len(texts), by_lang.shape[1]))
    for start in range(0, len(at), TOKENS_AT_ONCE):
        part = slice(start, start + TOKENS_AT_ONCE)
        weight = RECENT_MOST * before[part] / (before[part] + RECENT_HALF)
        p = by_lang[at[part]]
        p *= (1 - weight)[:, None]
        p += (weight * seen[part] / np.maximum(before[part], 1))[:, None]
        sums += np.add.reduceat(np.log(p, out=p), starts if start == 0 else [0])
    best = sums.max(axis=1)
    return (best + np.log(np.exp(sums - best[:, None]) @ share)) / math.log(10)


def in_blocks(texts: Iterable[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Texts in turn, together while they stay within ``TOKENS_AT_ONCE``."""
    block, size = [], 0
    for text in texts:
        if block and size + len(text) > TOKENS_AT_ONCE:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


SCORES = (
    "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double,"
    " n_bytes long, bits_per_byte double"
)


def score_texts(
    docs: DataFrame, held: Column, id_column: str = "doc_id", text: str = "text", lang: str | None = "lang"
) -> DataFrame:
    """``id_column`` and the scores of each row, learned from the rows that are not held out."""
    spark = docs.sparkSession
    train = docs.filter(~held)
    named = train.groupBy(F.lit(None).cast("string").alias("_lang") if lang is None else F.col(lang).alias("_lang"))
    common = named.count().orderBy(F.desc("count"), "_lang").limit(MOST_LANGS).collect()
    langs = [row[0] for row in common]
    size = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)))).first()[0] or 0
    rows = saved(counted(docs, held, lang, langs, 1 + size // BATCH_BYTES, id_column, text), "counted")
    words = rows.filter("bucket IS NOT NULL").select("batch", "bucket", "words", "counts", "langs")
    vocabulary = saved(words.groupBy("bucket").applyInPandas(merged, VOCABULARY), "vocabulary")
    sums = vocabulary.agg(F.sum("tokens"), F.sum("types")).first()
    all_tokens, all_types = sums[0] or 0, sums[1] or 0
    width = max(1, min(len(langs), MOST_LANGS))
    share = np.ones(width)
    share[: len(common)] += [row[1] for row in common]
    share[-1] += train.count() - sum(row[1] for row in common)
    share /= share.sum()
    tables = spark.sparkContext.broadcast(learned_tables(vocabulary, width))
    mixer = learned_mixer(vocabulary, tables, width)

    def answered(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return pd.DataFrame({"batch": [], "words": [], "times": [], "prices": []})
        words = unpacked_words(known["words"].iloc[0])
        counts = np.frombuffer(unpacked(known["counts"].iloc[0]), np.int64).reshape(-1, width)
        times, prices = counts.sum(axis=1), mixer.log10(tables.value, words, counts).astype(np.float32)
        places = {word: i for i, word in enumerate(words)}
        out = []
        for packed in asked["words"]:
            own = unpacked_words(packed)
            at = np.fromiter(map(places.__getitem__, own), np.int64, len(own))
            out.append((packed_array(times[at]), packed_array(prices[at])))
        return pd.DataFrame(
            {"batch": asked["batch"], "words": asked["words"], "times": [t for t, _ in out], "prices": [p for _, p in out]}
        )

    answers = words.groupBy("bucket").cogroup(vocabulary.groupBy("bucket")).applyInPandas(
        answered, "batch long, words binary, times binary, prices binary"
    )

    def scored(batch: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        places: dict[bytes, int] = {}
        tables_of = []
        for packed, times, prices in zip(told["words"], told["times"], told["prices"]):
            for word in unpacked_words(packed):
                places[word] = len(places)
            logs = np.frombuffer(unpacked(prices), np.float32).reshape(-1, width).astype(np.float64)
            tables_of.append((np.frombuffer(unpacked(times), np.int64), np.maximum(10.0**logs, 1e-300)))
        times, by_lang = (np.concatenate(parts) for parts in zip(*tables_of))
        base, known = base_log10(times, all_tokens, all_types), times > 0
        found = []

        def placed() -> Iterator[np.ndarray]:
            for held_out, packed in zip(batch["held"], batch["packed"]):
                text = unpacked(packed)
                tokens = words_of(text)
                tokens.append(b"")
                at = np.fromiter(map(places.__getitem__, tokens), np.int64, len(tokens))
                found.append((held_out, len(tokens), int(known[at].sum()), all_tokens, float(base[at].sum()), len(text)))
                yield at

        scores = [score for block in in_blocks(placed()) for score in texts_log10(block, by_lang, share).tolist()]
        found = [
            (*row[:-1], score, row[-1], -score / math.log10(2) / row[-1] if row[-1] else None) for row, score in zip(found, scores)
        ]
        out = pd.DataFrame(found, columns=[part.split()[0] for part in SCORES.split(", ")])
        out.insert(0, "_id", batch["_id"].to_numpy() if len(batch) else [])
        return out

    batches = rows.filter("packed IS NOT NULL").select("_id", "batch", "held", "packed")
    out = batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(scored, f"_id string, {SCORES}")
    kind = docs.schema[id_column].dataType
    return out.select(F.col("_id").cast(kind).alias(id_column), *out.columns[1:])
