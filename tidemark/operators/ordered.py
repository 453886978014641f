"""A global order with ranks, stored, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import new_folder

RANK = "report_rank"
_PLACE = "__place"
_RANGE = "__range"


def stored_in_order(df: DataFrame, order: Sequence[Column], rank: str = RANK) -> DataFrame:
    """``df`` with its place, from 1, in the given order; equal rows fall to a hash of all columns.

    Rows are dealt by ranges of the order and sorted within them, and stored
    once with the number of their range and their place in it. The rows of the
    ranges before are added from a list with one row for each range, so no task
    sees more than a range.
    """
    spark = df.sparkSession
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    folder = new_folder(spark, "in-order")
    # The number of a row: its partition's in the upper 31 bits, its place there in the lower 33.
    df.orderBy(*order, tie).withColumn(_PLACE, F.monotonically_increasing_id()).write.parquet(folder)
    stored = spark.read.parquet(folder)
    number = F.shiftright(_PLACE, 33)
    sizes = sorted(stored.groupBy(number.alias(_RANGE)).count().collect())
    before, starts = 0, []
    for part, size in sizes:
        starts.append((part, before))
        before += size
    offsets = spark.createDataFrame(starts, f"{_RANGE} long, __before long")
    placed = stored.withColumn(_RANGE, number).join(F.broadcast(offsets), _RANGE)
    return placed.withColumn(rank, F.col("__before") + F.col(_PLACE).bitwiseAND((1 << 33) - 1) + 1).drop(_RANGE, _PLACE, "__before")
