"""Queries pN_... over the tables of a data directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import cutoff, formatting, leakage, mixing, neardup, pairs, reading, repetition, tokens
from tidewright.llm.common import table
from tidewright.runtime import materialize, spread


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with long work per row, on all cores even if its files have few splits."""
    return spread(table(spark, sf_dir, name))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, kept = cutoff.keep_target_fraction(table(spark, sf_dir, "samples"), table(spark, sf_dir, "cutoff_targets"))
    return kept.select("sample_id")


def p1_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, _ = cutoff.keep_target_fraction(table(spark, sf_dir, "samples"), table(spark, sf_dir, "cutoff_targets"))
    return report


def p2_token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_budget(texts(spark, sf_dir, "samples"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(texts(spark, sf_dir, "samples")).where("repetitive").select("sample_id")


def p3_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.repetition(texts(spark, sf_dir, "samples"))
    return found.withColumn("failed", found["failed"].cast("string"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.broken_pairs(texts(spark, sf_dir, "samples")).select("sample_id", "defect")


def p4_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pairs.broken_pairs(texts(spark, sf_dir, "samples"))
    return found.select("sample_id", F.explode("defects").alias("defect"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatting.duplicate_records(table(spark, sf_dir, "samples"))[1]


def p5_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatting.duplicate_records(table(spark, sf_dir, "samples"))[0]


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes, _ = neardup.near_duplicates(table(spark, sf_dir, "samples"), size=3, threshold=0.6)
    return neardup.class_pairs(materialize(classes, "classes"))


def p6_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-word runs at a similarity of 0.8: one row per sample with its class and links."""
    return neardup.near_duplicates(table(spark, sf_dir, "samples"))[0]


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_items(texts(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "item_id")


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items of which a document holds a third or more."""
    return leakage.leaked_items(texts(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), least_share=1 / 3)


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.reading_levels(texts(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "band")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k[:1] == "p" and k[1:2].isdigit() and callable(v)}


def oracle_sql() -> dict[str, str]:
    from tidewright.llm import oracle

    return oracle.SQL
