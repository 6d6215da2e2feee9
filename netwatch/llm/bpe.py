"""Byte-level BPE: each slice of the corpus has its distinct words merged together, rank by rank.

The words of a slice of texts that are not in the vocabulary are laid out one after the other. An
inverted index holds, for each rank, the positions of the token pairs that the rank merges. Ranks are
taken in rising order; a merge touches the pairs to its left and right only. A word's tokens do not
depend on the words beside it, so slices need nothing from each other: no shuffle, and a lost task
repeats its own slice. The words of earlier slices of a task are kept, up to ``ENCODED_WORDS``; then the older half goes.
Ids and digests are made from what is kept for each word: its ids as text, and the bytes that its ids decode to.

Defined results: a NULL text is an empty text and has no tokens; special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterable
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame

from netwatch.llm.tasks import per_text

KEPT_WORDS = 250_000
# Words that an encoder keeps with their tokens: about 110 MB in each Python worker.
ENCODED_WORDS = 400_000
# Texts that an encoder splits at one time: their words, each an object, are most of what a worker holds for a moment.
SPLIT_BYTES = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file. The file is part of the installed tokenizers on each machine."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def pair_ranks(ranks: dict[bytes, int]) -> np.ndarray:
    """The rank of each pair of bytes, -1 where the pair is no token."""
    return np.array([ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)])


def replay(words: list[bytes], ranks: dict[bytes, int], pairs: np.ndarray | None = None) -> list[tuple[int, ...]]:
    """The token ids of each word, by merging all words together in rank order. ``pairs`` are the ``pair_ranks``.

    A token is known by where it starts; ``end`` and ``before`` lead to its neighbours. ``wanted`` is the
    rank of the pair that starts at a position, so entries of the index that no longer hold are seen.
    """
    text = b"".join(words)
    size = len(text)
    rank_of = ranks.get
    end = array("i", range(1, size + 1))
    before = array("i", range(-1, size - 1))
    opens = bytearray(size + 1)
    opens[size] = 1
    at = 0
    for word in words:
        opens[at] = 1
        at += len(word)
    index: dict[int, list[int]] = {}
    wanted = array("i", [-1]) * size
    if size > 1:
        codes = np.frombuffer(text, np.uint8).astype(np.int64)
        first = (pair_ranks(ranks) if pairs is None else pairs)[(codes[:-1] << 8) | codes[1:]]
        first[np.frombuffer(opens, np.uint8)[1:size] == 1] = -1
        wanted[:-1] = array("i", first.astype(np.intc).tobytes())
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0) :]
        found, starts = np.unique(first[order], return_index=True)
        for rank, a, b in zip(found.tolist(), starts, [*starts[1:], len(order)]):
            index[rank] = order[a:b].tolist()
    heap = list(index)
    heapify(heap)

    while heap:
        rank = heappop(heap)
        places = sorted(index.pop(rank))
        for k, i in enumerate(places):
            if wanted[i] != rank:
                continue
            middle = end[i]
            stop = end[i] = end[middle]
            wanted[middle] = -1
            lowest = rank
            if opens[stop]:
                wanted[i] = -1
            else:
                before[stop] = i
                found = wanted[i] = rank_of(text[i : end[stop]], -1)
                if found >= 0:
                    if found in index:
                        index[found].append(i)
                    else:
                        index[found] = [i]
                        heappush(heap, found)
                    if found < lowest:
                        lowest = found
            if not opens[i]:
                left = before[i]
                found = wanted[left] = rank_of(text[left:stop], -1)
                if found >= 0:
                    if found in index:
                        index[found].append(left)
                    else:
                        index[found] = [left]
                        heappush(heap, found)
                    if found < lowest:
                        lowest = found
            if lowest < rank:  # that one comes first; the rest of this rank waits
                if rest := places[k + 1 :]:
                    if rank in index:
                        index[rank].extend(rest)
                    else:
                        index[rank] = rest
                        heappush(heap, rank)
                break

    out = []
    at = 0
    for word in words:
        stop, ids = at + len(word), []
        while at < stop:
            ids.append(ranks[text[at : end[at]]])
            at = end[at]
        out.append(tuple(ids))
    return out


class Encoder:
    """Encodes texts; ``pattern`` splits them into words, whose tokens are found apart from each other."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = read_ranks(path)
        self.pairs = pair_ranks(self.ranks)
        self.words = regex.compile(pattern).findall
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.known: dict[str, tuple[str, bytes]] = {}  # the ids as text, and the bytes that they decode to

    def split(self, texts: list[bytes | None]) -> list[list[str]]:
        """The words of each text; those that are not known yet are merged first."""
        found = [self.words(text.decode("utf-8", "replace")) if text else [] for text in texts]
        if len(self.known) > ENCODED_WORDS:
            for old in list(islice(self.known, ENCODED_WORDS // 2)):
                del self.known[old]
        open_words = []
        for word in set().union(*found).difference(self.known):
            whole = self.ranks.get(word.encode())
            if whole is not None:
                self.known[word] = (str(whole), self.tokens[whole])
            else:
                open_words.append(word)
        for word, ids in zip(open_words, replay([word.encode() for word in open_words], self.ranks, self.pairs)):
            self.known[word] = (",".join(map(str, ids)), self.decode(ids))
        return found

    def encode(self, texts: list[bytes | None]) -> list[list[int]]:
        named = (",".join(self.known[word][0] for word in words) for words in self.split(texts))
        return [numbers(names).tolist() for names in named]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def numbers(names: str) -> np.ndarray:
    """The ids of a text, from their decimal names joined by commas."""
    return np.fromstring(names, np.int32, sep=",") if names else np.empty(0, np.int32)


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns and ``token_ids`` of each row's text."""

    def make() -> Callable[[list], dict[str, list]]:
        coder = Encoder(path, pattern)
        return lambda values: {"token_ids": coder.encode(values)}

    return per_text(docs, keep, "token_ids array<int>", make, text, SPLIT_BYTES)


def decode(encoded: DataFrame, path: str, keep: list[str], ids: str = "token_ids") -> DataFrame:
    """The kept columns and the ``decoded`` bytes of each row's ids; NULL ids give no bytes."""
    import pyarrow as pa

    out = encoded.select(*keep).schema.add("decoded", "binary")

    def run(batches):
        tokens = {rank: token for token, rank in read_ranks(path).items()}
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            found = [b"".join(map(tokens.__getitem__, row.as_py() or ())) for row in column]
            arrays = batch.columns[:-1] + [pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    return encoded.select(*keep, ids).mapInArrow(run, out)


def round_trip(
    docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text", with_ids: bool = False
) -> DataFrame:
    """Encodes and decodes each text in one pass: the number of tokens and digests of both results."""

    def make() -> Callable[[list], dict[str, list]]:
        coder = Encoder(path, pattern)

        def work(values: list) -> dict[str, list]:
            split = coder.split(values)
            found: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            if with_ids:
                found["token_ids"] = []
            for words in split:
                names, pieces = zip(*map(coder.known.__getitem__, words)) if words else ((), ())
                joined = ",".join(names)
                if with_ids:
                    found["token_ids"].append(numbers(joined))
                found["n_tokens"].append(joined.count(",") + 1 if words else 0)
                found["ids_sha256"].append(digest(joined.encode()))
                found["decoded_sha256"].append(digest(b"".join(pieces)))
            return found

        return work

    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return per_text(docs, keep, f"token_ids array<int>, {columns}" if with_ids else columns, make, text, SPLIT_BYTES)


def digest(value: bytes) -> str:
    return hashlib.sha256(value).hexdigest()
