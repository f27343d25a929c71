"""The corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, tokens."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from backglance.llm import bpe, decontam, queries, simhash, substrings, toxicity
from backglance.llm.words import small_batches
from backglance.sources.tables import load_table, pin


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    return toxicity.drop_toxic(docs, load_table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.drop_near_duplicates(docs, shingle=3, most=2, seed=42)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that windows of 20 words repeat from earlier places."""
    return substrings.drop_repeats(docs, window=20)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified benchmark item."""
    return decontam.drop_leaks(docs, load_table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.token_digests(docs, **queries.byte_bpe())


def _in_small_batches(stage):
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("toxicity", _in_small_batches(toxicity_stage)),
    ("simhash", _in_small_batches(near_duplicate_stage)),
    ("substrings", _in_small_batches(repeat_stage)),
    ("decontamination", _in_small_batches(leak_stage)),
    ("bpe", _in_small_batches(token_stage)),
]

# Classifiers, fingerprints and tokens have no SQL form: tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir))
    return docs
