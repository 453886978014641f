"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    collocations,
    embeddings,
    language_model,
    mixing,
    packing,
    pii,
    quality,
    quality_model,
    simhash,
    spelling,
    token_counts,
    token_files,
    toxicity,
)
from tidemark.llm.encoding import tokenizer_path
from tidemark.llm.frames import table
from tidemark.sources.scratch import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@register
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts through a digest cache that starts empty."""
    counted = token_counts.count_tokens(table(spark, folder, "documents"), tokenizer_path(), new_folder(spark, "token-cache"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > token_counts.OVER).alias("over_limit"))


@register
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of bounded-space packing; lengths and checksums come from their ids."""
    pieces = packing.pack(table(spark, folder, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


@register
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints and components of near copies."""
    return simhash.near_copies(table(spark, folder, "documents"))


@register
def op4_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of near vectors of one label."""
    return embeddings.near_vectors(table(spark, folder, "embeddings"))


SQL["op4_embeddings"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, COALESCE(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN counted USING (vec_id)
"""


@register
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Base statistics and the verdict of a decision list learned from the labels."""
    return quality.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register
def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """ORC token files in document order, read back."""
    files = new_folder(spark, "token-files")
    token_files.write_token_files(table(spark, folder, "documents"), tokenizer_path(), files)
    return token_files.token_file_digests(spark, files)


@register
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Targets of the sources, and the words that the mix takes of each document."""
    decided = mixing.decide(table(spark, folder, "documents"))
    return decided.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


@register
def op8_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Exact unigram scores, and scores by the log-frequency filter."""
    return language_model.score_texts(table(spark, folder, "documents"))


@register
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of the counterfactually regularised classifier."""
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data, base kinds and added ones."""
    return pii.pii_digests(pii.find_pii(table(spark, folder, "documents")))


@register
def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Words with their near words, forms and roots."""
    return spelling.variants(table(spark, folder, "documents"))


@register
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The first phrases of each language that hold together."""
    return collocations.collocations(table(spark, folder, "documents"))


@register
def op13_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of the hashed n-gram classifier."""
    return quality_model.rate(table(spark, folder, "documents"), table(spark, folder, "labels"))
