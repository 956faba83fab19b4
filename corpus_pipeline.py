"""A training corpus from raw documents, in five stages, each one of the subpackage's operators.

Every stage works on all that the one before kept; its result is written and read again, so a
lost executor costs no more than a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftloom.llm import decontamination, language, mixing, simhash, token_output
from driftloom.llm.common import table
from driftloom.llm.queries import tokenizer_path
from driftloom.sources.scratch import settle


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language that was learnt; those without letters go."""
    return language.with_known_language(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates, the one with the smallest id."""
    return simhash.keep_one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them; each comes at least once."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all that is left, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_output.token_digests(docs, tokenizer_path())


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", one_of_each),
    ("decontamination", without_benchmark),
    ("source_mixing", mixed_sources),
    ("token_output", token_ids),
]

#: SQL has neither the tokenizer, nor XXH64, nor the trained classifier; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage's result but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
