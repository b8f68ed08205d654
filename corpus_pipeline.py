"""Training-data pipeline over ``documents``: quality filter, near-duplicates,
benchmark decontamination, secret redaction, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; :func:`run` writes each stage's rows as Parquet and reads them again. A stage's result
is to be written before the next stage begins: that one deletes the tables that the
stage before it left, unless its ``docs`` still read them. The
first stages return the columns of ``documents``: documents that the classifier
rejects, later copies of a near-duplicate class and documents that hold a benchmark
window go; reported secrets are masked in the text.

Null, empty and very long texts, repeated rows and other columns pass through each
stage as its operator's docstring says; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermogrid.llm import byte_bpe, decontam, order_minhash, quality_lm, secrets_scan
from thermogrid.llm.common import discard_paths, intermediates, stored, table

_LEFT: list[str] = []  # tables written inside the stage before


def _tidy(stage: Callable[[SparkSession, DataFrame, str], DataFrame]):
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _LEFT[:] = discard_paths(spark, _LEFT, docs)
        with intermediates() as made:
            out = stage(spark, docs, sf_dir)
        _LEFT.extend(made)
        return out

    return run_stage


@_tidy
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_lm.keep_good(docs, table(spark, sf_dir, "labels"))


@_tidy
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.drop_near_duplicates(docs)


@_tidy
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), mode="documents")


@_tidy
def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets_scan.redact(docs)


@_tidy
def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digest of the decoded bytes."""
    both = byte_bpe.encode(docs, decoded=True)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("byte-level BPE", encoding_stage),
]

# The language model of the first stage is beyond SQL; the tests hold the
# pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
