"""Exact top-k by inner product between a question set and a document set.

Questions go to the tasks in passes of a fixed number. In a pass every task
scans its documents once, multiplies Arrow batches by one block of questions
after another and keeps k rows for each question, so documents stay where they
are and k rows for each task and question leave. A pass stores what it found
and frees its questions before the next begins, so driver, broadcast and tasks
hold one pass whatever the number of questions. No row is written out for
every pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keyed import ranked
from tidemark.sources.scratch import new_folder

# Rows of one product of matrices, and blocks that go to the tasks together: 50 MB at 384 dimensions.
QUESTIONS_PER_BLOCK = 4096
BLOCKS_PER_PASS = 4
# Products of matrices of other shapes differ in the last bits of a double; beyond these digits scores tie.
DIGITS = 12


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _best(question_ids: np.ndarray, document_ids: np.ndarray, scores: np.ndarray, k: int) -> pd.DataFrame:
    """k best documents of each question (rows of ``scores``), ties by document id."""
    k = min(k, scores.shape[1])
    rows, places = [], []
    for row, own in enumerate(scores):
        # Every document as good as the k-th, then ties in order.
        least = np.partition(own, len(own) - k)[len(own) - k]
        at = np.flatnonzero(own >= least)
        by_id = at[np.argsort(document_ids[at], kind="stable")]
        best = by_id[np.argsort(-own[by_id], kind="stable")[:k]]
        rows.append(np.full(len(best), row))
        places.append(best)
    rows, places = np.concatenate(rows), np.concatenate(places)
    return pd.DataFrame({"question_id": question_ids[rows], "doc_id": document_ids[places], "score": scores[rows, places]})


Block = tuple[np.ndarray, np.ndarray]


def _passes(questions: DataFrame, size: int, blocks: int) -> Iterator[list[Block]]:
    """Ids and matrices of questions, ``blocks`` blocks of at most ``size`` at a time on the driver."""
    ready: list[Block] = []
    rows: list[tuple] = []

    def block() -> Block:
        ids, vectors = zip(*rows, strict=True)
        rows.clear()
        return np.array(ids), np.array(vectors, np.float64)

    for row in questions.toLocalIterator():
        rows.append((row["question_id"], row["vector"]))
        if len(rows) == size:
            ready.append(block())
            if len(ready) == blocks:
                yield ready
                ready = []
    if rows:
        ready.append(block())
    if ready:
        yield ready


def _scan(blocks: list[Block], documents: DataFrame, k: int, digits: int, schema: str) -> str:
    """One scan of the documents for some blocks of questions; the folder that holds what was found."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(blocks)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame | None] = [None] * len(shared.value)
        for batch in batches:
            if batch.empty:
                continue
            document_ids, vectors = batch["doc_id"].to_numpy(), _matrix(batch["vector"]).T
            for place, (ids, matrix) in enumerate(shared.value):
                best = _best(ids, document_ids, np.round(matrix @ vectors, digits) + 0.0, k)
                both = best if kept[place] is None else pd.concat([kept[place], best], ignore_index=True)
                kept[place] = (
                    both.sort_values(["score", "doc_id"], ascending=[False, True], kind="stable")
                    .groupby("question_id", sort=False)
                    .head(k)
                )
        yield from (found for found in kept if found is not None)

    folder = new_folder(spark, "nearest")
    documents.mapInPandas(scan, schema).write.parquet(folder)
    shared.destroy()
    return folder


def top_k_documents(
    questions: DataFrame,
    documents: DataFrame,
    k: int = 5,
    digits: int | None = None,
    questions_per_block: int = QUESTIONS_PER_BLOCK,
    blocks_per_pass: int = BLOCKS_PER_PASS,
) -> DataFrame:
    """``question_id, doc_id, score, rank`` with ``rank <= k``.

    ``questions`` has ``question_id, vector``; ``documents`` has ``doc_id,
    vector``; ids are unique. Scores are rounded to ``digits`` before ranking,
    by default to ``DIGITS``, so that equal scores tie by document id. The
    search runs at once; what is returned reads the k best rows of each task.
    """
    questions = questions.select("question_id", "vector")
    documents = documents.select("doc_id", "vector")
    q = questions.schema["question_id"].dataType.simpleString()
    d = documents.schema["doc_id"].dataType.simpleString()
    schema = f"question_id {q}, doc_id {d}, score double"
    places = DIGITS if digits is None else digits
    folders = [_scan(blocks, documents, k, places, schema) for blocks in _passes(questions, questions_per_block, blocks_per_pass)]
    spark = documents.sparkSession
    found = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    return ranked(found, ["question_id"], [F.desc("score"), F.asc("doc_id")], k, "rank")
