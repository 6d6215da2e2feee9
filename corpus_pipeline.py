"""A corpus from raw documents to token ids: language, near-duplicates, benchmark passages, personal data, BPE.

Each stage takes the session, the documents that its predecessor kept, and the folder of the tables. All but
the last return the columns of documents; ``run`` writes each one's result to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from netwatch.llm import bpe, langid, pii, simhash, winnow
from netwatch.llm.tasks import read_table, saved

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain; others go. Learns as the query op3 does."""
    return langid.certain_only(docs, langid.train(langid.learnable(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    return simhash.first_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no run of words with a benchmark item."""
    return winnow.clean_only(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced by its kind."""
    return pii.mask_pii(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document's text, and their number and digests after decoding."""
    return bpe.round_trip(docs, VOCABULARY, public_tokenizers.PATTERN, ["doc_id"], with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

# Language models and fingerprints are beyond SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents; the last one is left to the caller to run."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
