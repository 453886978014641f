"""Tables whose columns bear the names that the operators use on the way."""

import pytest
from fixtures import prose
from pyspark.sql import functions as F

from tidemark.llm import mixing, quality, simhash, token_counts
from tidemark.llm.encoding import tokenizer_path

OWN = (
    "__row", "__list", "__lines", "__triples", "__n_words", "__word_chars", "__count", "__content", "__digest", "__text", "__id", "__none",
    "__tie", "__source", "__copy", "__times", "__turn", "root", "fp", "size", "times", "e", "o", "a.b",
)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, prose(k // 2, 70), "ab"[k % 2]) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.select("*", *[F.concat(F.lit(f"{n} "), "doc_id").alias(n) for n in OWN])


def same(found, docs, extra=()):
    """All rows of ``found`` are rows of ``docs``, value by value."""
    assert found.columns == [*docs.columns, *extra]
    known = {r.doc_id: tuple(r) for r in docs.collect()}
    rows = found.collect()
    assert rows and all(tuple(r)[: len(docs.columns)] == known[r.doc_id] for r in rows)
    return rows


def test_kept_rows_keep_their_columns(spark, docs):
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    assert len(same(quality.keep_good(docs, labels), docs)) == 12
    assert len(same(simhash.keep_one(docs), docs)) == 6
    assert len(same(mixing.mix(docs), docs)) >= 12


def test_counted_rows_keep_their_columns(spark, docs, tmp_path):
    found = token_counts.count_tokens(docs, tokenizer_path(), str(tmp_path / "cache"))
    assert len(same(found, docs, ("n_bytes", "n_tokens"))) == 12
    again = token_counts.count_tokens(found, tokenizer_path(), str(tmp_path / "cache"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found.collect()))
