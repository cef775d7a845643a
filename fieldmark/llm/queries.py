"""Registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldmark.llm import (
    decontaminate,
    fingerprints,
    languages,
    mixing,
    near_dups,
    quality,
    repeats,
    secrets,
    spelling,
    token_counts,
    token_files,
    twins,
    vector_codes,
    warc,
)
from fieldmark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path)


def op5_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_files.token_digests(spark, path)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "share", "changed")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op10_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.language_predictions(table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_repeats": op2_repeats,
    "op3_quality": op3_quality,
    "op4_warc": op4_warc,
    "op5_near_dups": op5_near_dups,
    "op6_mixture": op6_mixture,
    "op7_token_files": op7_token_files,
    "op8_decontaminate": op8_decontaminate,
    "op9_secrets": op9_secrets,
    "op10_languages": op10_languages,
    "op11_token_counts": op11_token_counts,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = twins.ORACLES
