"""Token counts under a unigram vocabulary, with the forward scores shared along a trie of words.

The distinct words of a slice of texts form a trie, walked depth first as a sorted list: a word takes
over the forward scores of the prefix that it shares with the word before, so that each prefix is
scored once. A forward score is the best sum of token scores that spells a prefix; of equal sums the
one with fewer tokens counts. The tokens of the best path at a word's end are its terminal count.

The vocabularies on the box carry ranks, not probabilities, and none is trained here. A token's score
is therefore that of a Zipf law over its rank, in whole millionths, so that sums are exact.

Defined results: NULL and empty texts have no tokens. Each single byte is in the vocabulary, so each
word can be spelled.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import chain

import regex
from pyspark.sql import DataFrame

from netwatch.llm.bpe import KEPT_WORDS, read_ranks
from netwatch.llm.tasks import per_text


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """Millionths of the natural logarithm of each token's share under Zipf's law."""
    total = math.log(sum(1 / (rank + 2) for rank in ranks.values()))
    return {token: round(-1e6 * (math.log(rank + 2) + total)) for token, rank in ranks.items()}


def backward(scores: dict[bytes, int]) -> dict:
    """The tokens as a trie from their last byte to their first; key -1 holds a token's score."""
    root: dict = {}
    for token, score in scores.items():
        node = root
        for byte in reversed(token):
            node = node.setdefault(byte, {})
        node[-1] = score
    return root


def terminal_counts(words: list[bytes], ends: dict) -> list[int]:
    """The number of tokens of the best path of each word of a sorted list."""
    best: list[tuple[int, int]] = [(0, 0)]  # score, and minus the number of tokens
    last = b""
    out = []
    for word in words:
        shared, most = 0, min(len(last), len(word))
        while shared < most and last[shared] == word[shared]:
            shared += 1
        del best[shared + 1 :]
        for stop in range(shared, len(word)):
            node, at, top = ends, stop, None
            while at >= 0 and (node := node.get(word[at])) is not None:
                if (score := node.get(-1)) is not None:
                    so_far, tokens = best[at]
                    here = (so_far + score, tokens - 1)
                    if top is None or here > top:
                        top = here
                at -= 1
            best.append(top)
        out.append(-best[len(word)][1])
        last = word
    return out


def token_counts(docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns of each row, its number of words and of tokens."""

    def make() -> Callable[[list], dict[str, list]]:
        ends = backward(zipf_scores(read_ranks(path)))
        split = regex.compile(pattern).findall
        known: dict[str, int] = {}

        def work(values: list) -> dict[str, list]:
            found = [split(value.decode("utf-8", "replace")) if value else [] for value in values]
            if len(known) > KEPT_WORDS:
                known.clear()
            new = sorted((word.encode(), word) for word in set(chain.from_iterable(found)).difference(known))
            counts = terminal_counts([word for word, _ in new], ends)
            known.update((word, count) for (_, word), count in zip(new, counts))
            return {
                "n_words": [len(words) for words in found],
                "n_tokens": [sum(map(known.__getitem__, words)) for words in found],
            }

        return work

    return per_text(docs, keep, "n_words long, n_tokens long", make, text)
