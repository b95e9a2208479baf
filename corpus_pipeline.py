"""The corpus pipeline: quality rules, near-dedup, mixing, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of documents.
SQL cannot express the stages (XXH64 fingerprints, connected components, Viterbi), so
``ORACLE_SQL`` is None and the tests hold ``run`` against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sylvan.llm import mixing, repetition, simhash, unigram
from sylvan.llm.queries import tokenizer_path
from sylvan.session import write_table
from sylvan.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return repetition.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` and its ids, one row for each row that the mix emits."""
    got = unigram.encode(docs, tokenizer_path("piece_bpe_32k.model"))
    return got.select("doc_id", "n_tokens", "ids", "round_trip")


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_dedup), ("source_mix", mix), ("sentencepiece", encode)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = write_table(docs, f"pipeline-{name}")
    return docs
