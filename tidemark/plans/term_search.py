"""Text vectors of weighted terms, and search by what the terms of a question weigh in each document.

A term weighs more the more often a text holds it and the fewer documents do.
Vectors are stored as one row for each text and term, so a search reads only
the rows of the questions' terms, nothing is hashed together, and each weight
can be checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup_join
from tidemark.operators.keyed import ranked

# Fixed value: what separates words.
BETWEEN_WORDS = r"[^\p{L}\p{N}_]+"
# Weights are rounded to nine places, so products of two add up exactly in any order.
WEIGHT = "decimal(10,9)"


def term_counts(df: DataFrame, key: str, column: str) -> DataFrame:
    """``key, term, tf``: how often each text holds each word, without case. Rows of a key count as one text.

    Texts are dealt by key before they are split, as a text is much shorter
    than its rows of words. What is grouped by key behind this stays in place.
    """
    words = F.explode(F.split(F.lower(F.col(column)), BETWEEN_WORDS))
    # As many parts as a shuffle has: merged to the size of the texts they would be too large for the words.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select(key, column).repartition(parts, F.col(key))
    return dealt.select(key, words.alias("term")).where("term <> ''").groupBy(key, "term").agg(F.count("*").alias("tf"))


def rarity(counts: DataFrame, key: str, documents: DataFrame) -> DataFrame:
    """``term, idf``: the logarithm of all documents by those with the term; terms of every document are left out."""
    # One row: the number of documents.
    everything = documents.agg(F.count("*").cast("double").alias("__all")).scalar()
    found = counts.groupBy("term").agg(F.count("*").alias("__with"))
    return found.select("term", F.log(everything / F.col("__with")).alias("idf")).where("idf > 0")


def term_weights(counts: DataFrame, key: str, idf: DataFrame) -> DataFrame:
    """``key, term, weight``: unit vectors over the terms that ``idf`` knows."""
    known = counts.where(F.col(key).isNotNull())
    raw = lookup_join(known, idf, "term", "inner").select(f"e.{key}", "e.term", ((1 + F.log("e.tf")) * F.col("o.idf")).alias("__raw"))
    # A window, not a join to the lengths, so that the rows are made and dealt by key once.
    length = F.sqrt(F.sum(F.col("__raw") * F.col("__raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", F.round(F.col("__raw") / length, 9).cast(WEIGHT).alias("weight"))


def document_weights(documents: DataFrame, key: str, column: str) -> tuple[DataFrame, DataFrame]:
    """Weights of all documents, and the rarity that questions are weighed by."""
    counts = term_counts(documents, key, column)
    idf = rarity(counts, key, documents)
    return term_weights(counts, key, idf), idf


def top_by_terms(questions: DataFrame, weights: DataFrame, key: str, k: int) -> DataFrame:
    """``question_id, key, score, rank``: the ``k`` best documents of each question, ties by key.

    ``questions`` and ``weights`` have ``term, weight``. A document that shares
    no term with a question does not appear.
    """
    asked = questions.select("question_id", "term", F.col("weight").alias("__asked"))
    # Rows of the asked terms only; Spark sends the questions to them where it measures the questions as small.
    found = weights.join(asked.withColumnRenamed("term", "__term"), F.col("term") == F.col("__term"))
    shared = found.groupBy("question_id", key).agg(F.sum(F.col("weight") * F.col("__asked")).alias("__exact"))
    scored = shared.select("question_id", key, F.col("__exact").cast("double").alias("score"))
    return ranked(scored, ["question_id"], [F.desc("score"), F.asc(key)], k, "rank")


def retrieve_by_terms(questions: DataFrame, documents: DataFrame, weights: DataFrame, idf: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents of each of ``questions(question_id, question)`` with text and metadata."""
    asked = term_weights(term_counts(questions, "question_id", "question"), "question_id", idf)
    best = top_by_terms(asked, weights, "doc_id", k)
    return best.join(documents, "doc_id").join(questions.select("question_id", "question"), "question_id")

