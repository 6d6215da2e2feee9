"""Language identification by interpolated Kneser-Ney models of characters, one per language.

Training counts the letter runs of each labelled row's words and learns, for each language, the
probability of a letter after up to ``ORDER - 1`` letters before it in the word; a word starts and ends with
a mark. Counts are made by Spark; the tables of all languages go to the tasks as arrays sorted by the hash of the
n-gram, with one column of log probabilities per language. A text's cross-entropy under a language is the
mean over all its letters; the lowest one wins.

The classifier learns from at most about ``MOST_ROWS`` rows per language, drawn by a hash of the row. Words
that are longer than ``LONGEST`` letters are read in parts of that length. This bounds the tables.

A prediction is rejected if the cross-entropy is far above what the language's own rows have: more than
``limit`` standard errors, which ``calibrated`` sets from training rows (see ``Model``).

Defined results: a text without a letter, NULL or empty gives ``und``, score 0, rejected. Equal
cross-entropies go to the language that sorts first. Without any training row each text gives ``und``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netwatch.llm.tasks import per_text, remainder, sliced, texts, where

ORDER = 4
MOST_ROWS = 2_000
LONGEST = 40
UNDETERMINED = "und"
KEPT_WORDS = 200_000
# Words whose letters are looked up at one time: each takes a few numbers per letter and language for a moment.
WORDS_AT_ONCE = 4_096
# Kneser-Ney takes this from each count; the part of the share that is spread over unseen letters.
DISCOUNT = 0.75
LETTERS = 3_000
# Fewest standard errors to reject, and what is added to the most that training rows show.
LEAST_LIMIT, MARGIN = 8.0, 1.5
START, END = "\u0002", "\u0003"

FIND = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def letter_runs(text: bytes | None) -> list[str]:
    return FIND.findall(text.decode("utf-8", "replace").lower()) if text else []


def parts(word: str) -> Iterator[str]:
    """The word with its marks, in parts of at most LONGEST letters."""
    for at in range(0, len(word), LONGEST):
        yield f"{START}{word[at : at + LONGEST]}{END}"


def training_rows(docs: DataFrame, most: int, lang: str, text: str, id_column: str) -> DataFrame:
    """About ``most`` rows per language, by a hash of id and text; all rows of a language that has fewer."""
    labelled = docs.filter(F.col(lang).isNotNull())
    counts = {row[0]: row[1] for row in labelled.groupBy(lang).count().collect()}
    share = F.lit(1.0)
    for name, count in counts.items():
        if count > most:
            share = F.when(F.col(lang) == name, most / count).otherwise(share)
    return labelled.filter(F.pmod(F.xxhash64(id_column, text), F.lit(1 << 20)) < share * (1 << 20))


def word_counts(rows: DataFrame, lang: str, text: str) -> DataFrame:
    """``lang, word, n`` of all rows, counted in tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for part, values in sliced(batch):
                for name, value in zip(part.column(0).to_pylist(), values):
                    found.update((name, word) for word in letter_runs(value))
            if len(found) > KEPT_WORDS:
                yield listed(found)
                found = Counter()
        yield listed(found)

    def listed(found: Counter) -> pa.RecordBatch:
        names, words = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_pydict(
            {"lang": pa.array(names, pa.string()), "word": pa.array(words, pa.string()),
             "n": pa.array(list(found.values()), pa.int64())}
        )

    part = texts(rows, F.col(lang).alias("_lang"), text=text)
    return part.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame, order: int) -> DataFrame:
    """``lang, gram, n`` for all n-grams of 1 to ``order`` letters that end behind a word's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for name, word, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for part in parts(word):
                    for stop in range(2, len(part) + 1):
                        for start in range(max(0, stop - order), stop):
                            found[name, part[start:stop]] += n
            names, grams = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array(names, pa.string()), "gram": pa.array(grams, pa.string()),
                 "n": pa.array(list(found.values()), pa.int64())}
            )

    counts = words.select("lang", "word", "n").mapInArrow(run, "lang string, gram string, n long")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: dict[str, int], order: int) -> tuple[dict[str, float], dict[str, float]]:
    """Log probabilities of the last letter of each n-gram after those before it, and of backing off by context.

    The highest order uses the counts; lower ones use the number of different letters before a gram, but
    for grams at a word's start, which nothing precedes. What the discount frees is given to the next
    lower order; below the lowest, to LETTERS equal letters.
    """
    before: Counter = Counter(gram[1:] for gram in counts if len(gram) > 1)
    probability: dict[str, float] = {"": 1 / LETTERS}
    freed: dict[str, float] = {}
    for n in range(1, order + 1):
        used = {g: (c if n == order or g[0] == START else before[g] or c) for g, c in counts.items() if len(g) == n}
        total: Counter = Counter()
        kinds: Counter = Counter()
        for gram, count in used.items():
            total[gram[:-1]] += count
            kinds[gram[:-1]] += 1
        for context in total:
            freed[context] = DISCOUNT * kinds[context] / total[context]
        for gram, count in used.items():
            context = gram[:-1]
            probability[gram] = (count - DISCOUNT) / total[context] + freed[context] * probability[gram[1:]]
    del probability[""]
    return {g: math.log(p) for g, p in probability.items()}, {c: math.log(p) for c, p in freed.items()}


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each n-gram that ends at a place; codes of words laid out one after the other."""
    out = np.zeros(len(codes), np.uint64) + np.uint64(n)
    for back in range(n - 1, -1, -1):
        shifted = np.concatenate([np.zeros(back, np.uint64), codes])[: len(codes)]
        out = (out ^ shifted) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


class Table(NamedTuple):
    """Hashes in rising order, and for each a row with a number per language (NaN: not seen there)."""

    hashes: np.ndarray
    rows: np.ndarray

    def find(self, wanted: np.ndarray, missing: float) -> np.ndarray:
        if not len(self.hashes):
            return np.full((len(wanted), self.rows.shape[1]), missing, np.float32)
        at = np.searchsorted(self.hashes, wanted)
        at[at == len(self.hashes)] = 0
        found = self.rows[at]
        found[self.hashes[at] != wanted] = missing
        return found


def table(models: Sequence[dict[str, float]], n: int) -> Table:
    """The entries of ``n`` letters of each language's dictionary, side by side."""
    grams = sorted({gram for model in models for gram in model if len(gram) == n})
    rows = np.array([[model.get(gram, np.nan) for model in models] for gram in grams], np.float32)
    if not n:
        return Table(np.zeros(len(grams), np.uint64), rows.reshape(len(grams), len(models)))
    codes = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).astype(np.uint64)
    keys = gram_hashes(codes, n)[n - 1 :: n]
    turn = np.argsort(keys)
    return Table(keys[turn], rows.reshape(len(grams), len(models))[turn])


class Model(NamedTuple):
    """For each order the log probabilities of n-grams; for each length of context that of backing off.

    ``mean``, ``spread`` and ``drift`` are of the cross-entropy of a language's rows: its mean, its spread
    per letter and that between rows; ``limit`` is in standard errors.
    """

    langs: list[str]
    grams: list[Table]
    freed: list[Table]
    mean: np.ndarray
    spread: np.ndarray
    drift: np.ndarray
    limit: np.ndarray

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of log probabilities per language, and number of letters with the end mark, of each word."""
        split = [list(parts(word)) for word in words]
        flat = list(chain.from_iterable(split))
        lengths = np.fromiter(map(len, flat), np.int64, len(flat))
        codes = np.frombuffer("".join(flat).encode("utf-32-le"), np.uint32).astype(np.uint64)
        depth = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        logs = np.zeros((len(codes), len(self.langs)), np.float32)
        missing = np.ones(logs.shape, bool)
        missing[depth == 0] = False
        for n in range(len(self.grams), 0, -1):
            places = np.flatnonzero(missing.any(axis=1) & (depth >= n - 1))
            found = self.grams[n - 1].find(gram_hashes(codes, n)[places], np.nan)
            new = missing[places]
            seen = new & ~np.isnan(found)
            contexts = gram_hashes(codes, n - 1)[places - 1] if n > 1 else np.zeros(len(places), np.uint64)
            off = np.nan_to_num(self.freed[n - 1].find(contexts, 0.0), nan=0.0)
            logs[places] += np.where(seen, found, np.where(new, off, 0))
            missing[places] &= ~seen
        logs[missing] -= np.float32(np.log(LETTERS))
        ends = np.cumsum(lengths) - lengths
        sums = np.add.reduceat(logs.astype(np.float64), ends, axis=0)
        first = np.cumsum([0, *map(len, split)])[:-1]
        return np.add.reduceat(sums, first, axis=0), np.add.reduceat(lengths - 1, first)


class Known:
    """Sums and letters of the words seen before, a row of numbers each, up to about ``KEPT_WORDS``."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.model.langs) + 1))

    def add(self, words: set[str]) -> None:
        if len(self.places) > KEPT_WORDS:
            self.clear()
        new = list(words.difference(self.places))
        rows = [self.rows]
        for start in range(0, len(new), WORDS_AT_ONCE):
            rows.append(np.column_stack(self.model.words(new[start : start + WORDS_AT_ONCE])))
        self.rows = np.concatenate(rows)
        self.places.update(zip(new, range(len(self.places), len(self.rows))))

    def total(self, words: list[str]) -> np.ndarray:
        return self.rows[np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))].sum(axis=0)


def entropies(runs: list[list[str]], known: Known) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per language and number of letters of texts given by their letter runs."""
    known.add(set(chain.from_iterable(runs)))
    out = np.zeros((len(runs), known.rows.shape[1]))
    for i, words in enumerate(runs):
        if words:
            out[i] = known.total(words)
    letters = out[:, -1]
    return -out[:, :-1] / np.maximum(letters, 1)[:, None], letters


def train(
    docs: DataFrame, lang: str = "lang", text: str = "text", id_column: str = "doc_id",
    order: int = ORDER, most_rows: int = MOST_ROWS,
) -> Model:
    """The model of all rows given; leave out held-out ones before."""
    rows = training_rows(docs, most_rows, lang, text, id_column)
    counts: dict[str, dict[str, int]] = {}
    for batch in gram_counts(word_counts(rows, lang, text), order).toArrow().to_batches(10_000):
        for name, gram, n in zip(*(column.to_pylist() for column in batch.columns)):
            counts.setdefault(name, {})[gram] = n
    langs = sorted(counts)
    grams, freed = zip(*(kneser_ney(counts[name], order) for name in langs)) if langs else ((), ())
    ones = np.ones(len(langs))
    seen = [table(grams, n) for n in range(1, order + 1)]
    open_ = [table(freed, n) for n in range(order)]
    model = Model(langs, seen, open_, 0 * ones, ones, ones, 1e9 * ones)
    return calibrated(model, rows, lang, text) if langs else model


def calibrated(model: Model, rows: DataFrame, lang: str, text: str) -> Model:
    """With the mean cross-entropy of each language's rows, its variance as ``spread² / letters + drift²``.

    Rows give their own language's cross-entropy and length; sums over short and long rows give the two
    parts of the variance. The limit is above the greatest deviation that all but one in a thousand rows show.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[list], dict[str, list]]:
        known = Known(shared.value)

        def work(values: list) -> dict[str, list]:
            found, letters = entropies([letter_runs(v) for v in values], known)
            return {"entropies": found.tolist(), "letters": letters}

        return work

    named = rows.select(F.col(lang).alias("_lang"), F.col(text).alias("_own"))
    found = per_text(named, ["_lang"], "entropies array<double>, letters double", make, "_own")
    own = found.filter(F.col("letters") > 0).select(
        "_lang", F.element_at("entropies", F.array_position(F.array(*map(F.lit, model.langs)), F.col("_lang")).cast("int")).alias("h"), "letters"
    )
    table = own.toPandas()  # three numbers for each of the sampled rows
    mean, spread, drift, limit = (np.ones(len(model.langs)) for _ in range(4))
    for i, name in enumerate(model.langs):
        part = table[table["_lang"] == name]
        h, letters = part["h"].to_numpy(float), part["letters"].to_numpy(float)
        if not len(h):
            mean[i], limit[i] = 0, 1e9
            continue
        mean[i] = np.average(h, weights=np.minimum(letters, 1_000))
        off = (h - mean[i]) ** 2
        spread[i] = np.sqrt(max(np.median(off * letters) / 0.455, 1e-6))  # 0.455: median of a squared normal
        drift[i] = np.sqrt(max(np.median(off[letters >= np.median(letters)]) / 0.455, 1e-6))
        z = (h - mean[i]) / np.sqrt(spread[i] ** 2 / letters + drift[i] ** 2)
        limit[i] = max(LEAST_LIMIT, MARGIN * np.quantile(z, 0.999))
    return model._replace(mean=mean, spread=spread, drift=drift, limit=limit)


def identify(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, ``lang_pred``, ``score``, ``entropy`` in nats per letter, and ``rejected``.

    The score is the winner's share of exp(-entropy * letters) over all languages, at most 200 letters.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[list], dict[str, list]]:
        model = shared.value
        known = Known(model)

        def work(values: list) -> dict[str, list]:
            found, letters = entropies([letter_runs(v) for v in values], known)
            if not model.langs:
                none = [None] * len(values)
                return {"lang_pred": [UNDETERMINED] * len(values), "score": [0.0] * len(values),
                        "entropy": none, "rejected": [True] * len(values)}
            best = found.argmin(axis=1)
            low = found[np.arange(len(best)), best]
            weight = np.exp((low[:, None] - found) * np.minimum(letters, 200)[:, None])
            z = (low - model.mean[best]) / np.sqrt(model.spread[best] ** 2 / np.maximum(letters, 1) + model.drift[best] ** 2)
            some = letters > 0
            return {
                "lang_pred": [model.langs[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), some)],
                "score": np.where(some, 1 / weight.sum(axis=1), 0.0),
                "entropy": [h if ok else None for h, ok in zip(low.tolist(), some)],
                "rejected": ~some | (z > model.limit[best]),
            }

        return work

    return per_text(docs, keep, "lang_pred string, score double, entropy double, rejected boolean", make, text)


def certain_only(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose language is not rejected, with all their columns."""
    return where(docs, lambda rows, keep, name: identify(rows, model, keep, name), "NOT rejected", text)


def learnable(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The rows that are not held out."""
    return docs.filter(~held_out(id_column))


def held_out(id_column: str = "doc_id"):
    return remainder(F.col(id_column), 4) == 2
