"""The registered corpus queries over whole small tables, against plain versions."""

import base64
import math

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as driver
from netwatch.llm import sentences
from tests.llm import brute

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text", "lang").collect()
    items = spark.read.parquet(f"{TABLES}/benchmark.parquet").select("item_id", "text").collect()
    return [tuple(r) for r in docs], [tuple(r) for r in items]


@pytest.fixture(scope="module")
def texts(tables):
    return [(doc_id, text) for doc_id, text, _ in tables[0]]


def result(spark, name, *columns):
    found = driver.queries()[name](spark, TABLES)
    return sorted(tuple(r) for r in found.select(*columns).collect())


def test_byte_bpe(spark, texts):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for doc_id, text in texts:
        ids = own.encode_ordinary(text)
        expected.append((doc_id, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(text)))
    assert result(spark, "op2_byte_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected


def test_language_id_on_held_out_rows(spark, tables):
    langs = {doc_id: lang for doc_id, _, lang in tables[0]}
    found = result(spark, "op3_language_id", "doc_id", "held_out", "lang_pred", "score")
    assert [r[0] for r in found] == sorted(langs)
    assert all(held == (brute.crc(doc_id) % 4 == 2) for doc_id, held, _, _ in found)
    assert all(0 <= score <= 1 for *_, score in found)
    held = [(lang, langs[doc_id]) for doc_id, out, lang, _ in found if out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_lm_scores(spark, texts):
    expected = brute.base_scores(texts)
    found = driver.queries()["op4_lm_scores"](spark, TABLES).collect()
    assert sorted(r.doc_id for r in found) == sorted(expected)
    for r in found:
        held, n, known, total, base = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0
    train = [r for r in found if not r.held_out]
    assert sum(r.score for r in train) > sum(r.base_score for r in train)


def test_lm_scores_on_held_out_rows(spark):
    """A thousand documents; the hundred of the smaller table are too few to beat the base."""
    found = driver.queries()["op4_lm_scores"](spark, "/root/testdata/sf0.01").filter("held_out").collect()
    assert sum(r.score for r in found) > sum(r.base_score for r in found)


def test_suffix_dedup(spark, texts):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert result(spark, "op5_suffix_dedup", *columns) == sorted(brute.repeated_strings(texts, 200))


def test_sentence_spans(spark, texts):
    expected = brute.sentence_spans(texts, sentences.RUN, sentences.FEWEST, sentences.WORDS, sentences.sentences)
    assert result(spark, "op6_sentence_spans", "doc_id", "n_sentences", "n_removed", "kept_sha256") == sorted(expected)


def test_quality_statistics(spark, texts):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    expected = [(doc_id, *(s := brute.statistics(text)), brute.base_failed(s)) for doc_id, text in texts]
    assert result(spark, "op7_quality_outliers", *columns) == expected
    verdicts = result(spark, "op7_quality_outliers", "base_failed", "kept")
    assert not any(failed and kept for failed, kept in verdicts)


def test_pii(spark, texts):
    expected = []
    for doc_id, text in texts:
        spans = brute.base_spans(text)
        counts = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
        expected.append((doc_id, *counts, brute.sha(brute.spans_text(spans))))
    columns = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert result(spark, "op8_pii", *columns) == expected


def test_simhash(spark, texts):
    expected = brute.simhash_classes(texts, 4, 4)
    assert result(spark, "op9_simhash", "doc_id", "fingerprint", "component_id") == sorted(expected)


def test_winnowing(spark, tables, texts):
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert result(spark, "op10_winnowing", *columns) == brute.contamination(texts, tables[1])


def test_token_counts_add_up(spark, texts):
    found = result(spark, "op1_token_counts", "doc_id", "n_words", "n_tokens")
    assert [r[0] for r in found] == [doc_id for doc_id, _ in texts]
    assert all(words <= tokens for _, words, tokens in found)
