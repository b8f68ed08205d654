"""One query per operator over the whole of its table, and DuckDB SQL where SQL
can express the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from thermogrid.llm import (byte_bpe, decontam, embed_dedup, lang_id, lattice_lm, order_minhash, quality_lm,
                            secrets_scan, source_audit, spelling, suffix_dedup, toxicity, url_filter)
from thermogrid.llm.common import table


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.op1_minhash_neardup(table(spark, sf_dir, "documents"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.op2_decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.op3_suffix_dedup(table(spark, sf_dir, "documents"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lm.op4_quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.op5_secret_scans(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.op6_url_filters(table(spark, sf_dir, "pages"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.op7_language_id(table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.op8_lm_scoring(table(spark, sf_dir, "documents"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.op9_embedding_neardup(table(spark, sf_dir, "embeddings"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.op10_byte_bpe(table(spark, sf_dir, "documents"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.op11_spelling_variants(table(spark, sf_dir, "documents"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op12_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.op13_source_divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_neardup": op1,
    "op2_decontamination": op2,
    "op3_suffix_dedup": op3,
    "op4_quality_classifier": op4,
    "op5_secret_scans": op5,
    "op6_url_filters": op6,
    "op7_language_id": op7,
    "op8_lm_scoring": op8,
    "op9_embedding_neardup": op9,
    "op10_byte_bpe": op10,
    "op11_spelling_variants": op11,
    "op12_toxicity": op12,
    "op13_source_divergence": op13,
}

ORACLE: dict[str, str] = {
    "op2_decontamination": decontam.OP2_SQL,
    "op6_url_filters": url_filter.OP6_SQL,
    "op9_embedding_neardup": embed_dedup.OP9_SQL,
    "op13_source_divergence": source_audit.OP13_SQL,
}
