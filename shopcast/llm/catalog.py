"""Queries of the thirteen operators: each reads its whole table and applies its
operator with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopcast.llm import (align, backoff, decontaminate, exact, extract, minhash, mixing, repetition,
                          secret_scan, suffixes, toxicity, urls, whitening)
from shopcast.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_text(read(spark, sf_dir, "pages"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(read(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.draws(read(spark, sf_dir, "documents"))


def op6_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.backoff_scores(read(spark, sf_dir, "documents"))


def op7_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(read(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secrets(read(spark, sf_dir, "documents")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_verdicts(read(spark, sf_dir, "pages"))


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.digest(read(spark, sf_dir, "documents"))


def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.copies(read(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_decontaminate, op2_extract, op3_minhash, op4_suffixes, op5_mixing, op6_backoff,
        op7_repetition, op8_secrets, op9_toxicity, op10_urls, op11_align, op12_exact, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    """The others can't be had from SQL on the whole tables in reasonable
    time; the tests compare them with brute force instead."""
    return {"op12_exact": exact.ORACLE_SQL}
