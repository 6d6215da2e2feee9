"""Repeats that hold no three long sentences."""

import random
import string

from netwatch.llm import sentences


def removed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: (r.n_removed, r.kept) for r in sentences.without_repeated_spans(docs).collect()}


def sentence(rng, n, end="."):
    return " ".join("".join(rng.choices(string.ascii_lowercase, k=6)) for _ in range(n)) + end


def test_copies_of_short_sentences(spark):
    text = "\n".join(f"{i} a." for i in range(50))
    got = removed(spark, [(1, text), (2, text), (3, "Yes. No."), (4, "Yes. No."), (5, "Yes. No. Perhaps."), (6, "ab\n" * 400)])
    assert {i: n for i, (n, _) in got.items()} == {1: 0, 2: 50, 3: 0, 4: 2, 5: 0, 6: 0}
    assert got[2][1] == ""


def test_planted_passages_of_fifty_words(spark):
    rng = random.Random(4)
    rows, expected = [], {}
    for i in range(60):
        passage = [[50], [25, 25], [10, 40], [17, 17, 16], [5] * 10, [1] * 50][i % 6]
        planted = " ".join(sentence(rng, n) for n in passage)
        before = [f"{sentence(rng, 9)} {sentence(rng, 30)} " for _ in range(2)]
        after = [f" {sentence(rng, 12)} {sentence(rng, 7)}" for _ in range(2)]
        rows += [(2 * i, before[0] + planted + after[0]), (2 * i + 1, before[1] + planted + after[1])]
        expected |= {2 * i: (0, rows[-2][1]), 2 * i + 1: (len(passage), before[1] + after[1][1:])}
    assert removed(spark, rows) == expected


def test_sentence_ends_of_other_scripts():
    assert sentences.sentences("これは文です。次の文です！「はい。」終わり") == ["これは文です。", "次の文です！", "「はい。」", "終わり"]
    assert sentences.sentences("यह है। वह है॥ क्या؟ end… more") == ["यह है।", " वह है॥", " क्या؟", " end…", " more"]
