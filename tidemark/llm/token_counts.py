"""Token counts through a cache of content digests."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.encoding import encoder, tokenizer_digest
from tidemark.llm.frames import ROW, as_row, row_columns, whole_text

KEY = "__content"
OVER = 1024
CACHE = "content string, n_tokens long"


def _first_in_task(texts: DataFrame) -> DataFrame:
    """Drop copies that the same task has sent already, so no content reaches the shuffle in great number."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            keep = []
            for digest in batch.column(0).to_pylist():
                short = bytes.fromhex(digest)
                keep.append(short not in seen)
                seen.add(short)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return texts.mapInArrow(each, texts.schema)


def _counted(texts: DataFrame, path: str) -> DataFrame:
    """Token counts of the distinct contents; copies lie in one partition or are merged later."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(path), set()
        for batch in batches:
            keep = []
            for digest in batch.column(0).to_pylist():
                short = bytes.fromhex(digest)
                keep.append(short not in seen)
                seen.add(short)
            batch = batch.filter(pa.array(keep, pa.bool_()))
            offsets, _ = encode.encode_all(batch.column(1), counts_only=True)
            counts = pa.array(offsets[1:] - offsets[:-1], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts], ["content", "n_tokens"])

    return texts.mapInArrow(each, CACHE)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, text: str = "text") -> DataFrame:
    """Add ``n_bytes`` and ``n_tokens`` to ``docs``; ``cache`` is a folder that executors share.

    The cache holds one count for each pair of content digest (SHA-256 of the
    text; null counts as empty, the only change that leaves every count as it
    is) and tokenizer digest (SHA-256 of its file). Contents that it lacks are
    sent once from each task, shuffled by digest, encoded once and appended;
    then all rows read their count from the cache, so a second run encodes
    nothing. Copies, ties, null ids and extra columns need no care: ids are
    not looked at, rows keep all their columns (``n_bytes`` and ``n_tokens``
    are replaced). An empty table gives an empty result.
    """
    spark = docs.sparkSession
    version = f"{cache.rstrip('/')}/tokenizer={tokenizer_digest(tokenizer)}"
    digested = docs.select(as_row(docs), whole_text(text).alias("__text"), F.sha2(whole_text(text), 256).alias(KEY))

    def cached() -> DataFrame:
        # Two writers may have appended the same content.
        return spark.read.schema(CACHE).parquet(version).groupBy("content").agg(F.max("n_tokens").alias("__count"))

    spark.createDataFrame([], CACHE).write.mode("append").parquet(version)
    contents = _first_in_task(digested.select(KEY, "__text"))
    missing = contents.join(cached().withColumnRenamed("content", KEY), KEY, "left_anti")
    # Where the cache is small the join above needs no shuffle, so deal by digest here in any case.
    _counted(missing.repartition(F.col(KEY)), tokenizer).write.mode("append").parquet(version)
    # The key is derived anew so that the join gets an exchange on both sides and AQE can split a hot content.
    counts = cached().select(F.concat("content", F.lit("")).alias("__digest"), "__count")
    measured = digested.select(ROW, KEY, F.octet_length("__text").cast("long").alias("n_bytes"))
    return measured.join(counts, F.col(KEY) == F.col("__digest"), "left").select(
        *row_columns(c for c in docs.columns if c not in ("n_bytes", "n_tokens")), "n_bytes", F.col("__count").alias("n_tokens")
    )
