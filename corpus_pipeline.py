"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, packing, pii, quality, simhash
from tidemark.llm.encoding import tokenizer_path
from tidemark.llm.frames import table
from tidemark.sources.scratch import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from the labels."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the least id."""
    return simhash.keep_one(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to the name of their kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2,048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("simhash", keep_one_copy),
    ("pii", redact_pii),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Learned rules, XXH64 fingerprints and token ids are beyond the oracle's SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each reads what the one before wrote to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        if k:
            folder = new_folder(spark, f"stage-{k}")
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
        docs = stage(spark, docs, sf_dir)
    return docs
