"""Registered queries over the given tables, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from annoframe.llm import bpe, languages, lines, mixing, near, periods, pii, quality, sketch, spelling, tokens, warc, wrappers
from annoframe.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.report(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.report(table(spark, sf_dir, "documents"), plain=True)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.report(table(spark, sf_dir, "documents"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.report(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_line_dedup,
        op2_pii,
        op3_source_mixing,
        op4_quality_rules,
        op5_warc,
        op6_bpe,
        op7_fingerprints,
        op8_html_extraction,
        op9_near_dedup,
        op10_token_files,
        op11_language_id,
        op12_spelling_variants,
        op13_periodic_runs,
    )
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": lines.sql(),
    "op3_source_mixing": mixing.sql(),
    "op4_quality_rules": quality.sql(),
    "op5_warc": warc.sql(),
}
