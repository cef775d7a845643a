"""The corpus pipeline: language, near-duplicates, benchmark leaks, mixture, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldmark.llm import decontaminate, languages, mixing, near_dups, token_files
from fieldmark.llm.queries import table, tokenizer_path
from fieldmark.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the language models reject (no letter, or unlike every language)."""
    return languages.accepted(docs, languages.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the least id."""
    return near_dups.one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a benchmark item leaks into."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per pass over a document, in training order; documents that the mix leaves out go."""
    return mixing.mixed(docs, size_column="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token files, in the order of the mixture's files, read back: a row per document pass."""
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(docs, path, tokenizer_path(), order=token_files.file_order(docs))
    return token_files.token_digests(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontamination),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: Language models, hash signatures and the tokenizer have no SQL form; tests hold the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
