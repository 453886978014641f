"""Token ids as ORC files in document order."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.encoding import encoder
from tidemark.llm.frames import held, whole_text

END = 0
ROW_STRIDE = 1000
STRIPE_BYTES = 8 * 1024 * 1024
FILES = "doc_id long, part int, place long, ids array<int>"


def write_token_files(
    docs: DataFrame, tokenizer: str, folder: str, end: int = END, parts: int | None = None
) -> None:
    """Write every text's ids and an end id to ORC files under ``folder``.

    Rows are ``doc_id``, ``part`` (the file's number), ``place`` (the row's
    number in it) and ``ids``; ascending by document id over all files, null
    ids first, rows of one id by the hash of their text (equal rows are
    interchangeable). ORC writes the ids with integer run-length encoding,
    cuts stripes that readers take in parallel, and keeps row indexes and a
    Bloom filter on ``doc_id``, so a look-up by id skips stripes and strides.
    Null texts hold the end id alone. An empty table gives files without rows.
    """
    spark = docs.sparkSession
    count = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"),
        F.xxhash64(whole_text()).alias("tie"),
    )
    ordered = rows.repartitionByRange(count, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part, place = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            offsets, ids = encode.encode_all(batch.column(1))
            ids = np.insert(ids.view("<i4"), offsets[1:], end)
            lists = pa.ListArray.from_arrays(
                pa.array((offsets + np.arange(len(offsets))).astype(np.int32)), pa.array(ids, pa.int32())
            )
            n = len(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(n, part, np.int32)),
                 pa.array(np.arange(place, place + n)), lists],
                ["doc_id", "part", "place", "ids"],
            )
            place += n

    (ordered.select("doc_id", "text").mapInArrow(each, FILES).write
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(ROW_STRIDE))
     .option("orc.stripe.size", str(STRIPE_BYTES)).option("compression", "zstd").orc(folder))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the files. A filter on ``doc_id`` prunes by stripe statistics and Bloom filters."""
    return spark.read.schema(FILES).orc(folder)


def token_file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """For each row of the files: ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32``.

    Starts are sums over files and then within a file, so no task sees more
    than one file's rows and the table of files has one row for each.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), batch.column("place"),
                 pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())],
                ["doc_id", "part", "place", "n_tokens", "ids_crc32"],
            )

    rows = held(read_token_files(spark, folder).mapInArrow(
        each, "doc_id long, part int, place long, n_tokens long, ids_crc32 long"
    ))
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("all"))
    before = totals.select(
        F.col("part").alias("__part"),
        (F.sum("all").over(Window.orderBy("part")) - F.col("all")).alias("__before"),
    )
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("place")) - F.col("n_tokens")
    return (
        rows.withColumn("__inside", inside)
        .join(before, F.col("part") == F.col("__part"))
        .select("doc_id", (F.col("__before") + F.col("__inside")).alias("start"), "n_tokens", "ids_crc32")
    )
