"""The registered queries of these operators: each runs over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from netwatch.llm import (
    bpe,
    convnet,
    langid,
    mixing,
    outliers,
    phrases,
    pii,
    repeats,
    resample,
    sentences,
    simhash,
    unigram,
    winnow,
)
from netwatch.llm.oracles import ORACLES as SQL
from netwatch.llm.tasks import read_table, remainder

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents")


def _sha(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Words and tokens of each document under the unigram vocabulary."""
    return unigram.token_counts(_documents(spark, folder), VOCABULARY, PATTERN, ["doc_id"])


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of each document, and digests of its ids and of what they decode to."""
    return bpe.round_trip(_documents(spark, folder), VOCABULARY, PATTERN, ["doc_id"])


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of each document, learned from those that are not held out."""
    docs = _documents(spark, folder)
    model = langid.train(langid.learnable(docs))
    found = langid.identify(docs.withColumn("held_out", langid.held_out()), model, ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "entropy", "rejected")


def op4_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of each document, learned from those that are not held out."""
    return mixing.score_texts(_documents(spark, folder), remainder(F.col("doc_id"), 10) == 0)


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of each document without its repeated strings."""
    found = repeats.without_repeats(_documents(spark, folder))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", _sha(F.col("kept")).alias("kept_sha256"))


def op6_sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of each document without its repeated runs of sentences."""
    found = sentences.without_repeated_spans(_documents(spark, folder))
    kept = F.coalesce("kept", F.lit(""))
    return found.select("doc_id", "n_sentences", "n_removed", _sha(kept).alias("kept_sha256"))


def op7_quality_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics and verdict of each document."""
    return outliers.judged(_documents(spark, folder), ["doc_id"])


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of each document."""
    return pii.count_pii(_documents(spark, folder), ["doc_id"])


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and class of each document."""
    found = simhash.near_duplicates(_documents(spark, folder), size=4)
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


def op10_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that each document shares with benchmark items."""
    found = winnow.contaminated(_documents(spark, folder), read_table(spark, folder, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        _sha(F.array_join("item_ids", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best phrases of each language."""
    return phrases.collocations(_documents(spark, folder))


def op12_byte_convnet(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of each document, learned from labels of documents that are not held out."""
    docs = _documents(spark, folder)
    network = convnet.train(docs, read_table(spark, folder, "labels"))
    found = convnet.scored(docs.withColumn("held_out", convnet.held_out()), network, ["doc_id", "held_out"])
    return found.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, noisy sum and rank of each document when a tenth is drawn towards the benchmark."""
    return resample.resampled(_documents(spark, folder), read_table(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_token_counts, op2_byte_bpe, op3_language_id, op4_lm_scores, op5_suffix_dedup, op6_sentence_spans,
        op7_quality_outliers, op8_pii, op9_simhash, op10_winnowing, op11_phrase_collocations, op12_byte_convnet,
        op13_importance_resampling,
    )
} | {"pipeline": corpus_pipeline.run}

ORACLES: dict[str, str] = SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
