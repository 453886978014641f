"""One row, or the first few rows, for each key, with a fixed winner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"
_TIE = "__tie"


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of each key.

    Spark keeps only ``k`` rows of a key in each map task before the shuffle
    (window group limit), so a key that holds much of the data stays cheap.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, place).filter(F.col(_RANK) <= k).drop(_RANK)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row of each key, the same one in every run.

    Rows that ``order`` leaves equal are told apart by a hash over all columns.
    The hash alone is shuffled and sorted, so columns that a caller does not
    use are still pruned, and callers that use different columns get the same
    row.
    """
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return top_per_key(df.withColumn(_TIE, tie), keys, [*order, F.col(_TIE)], 1).drop(_TIE)


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str) -> DataFrame:
    """Like :func:`top_per_key`, keeping the rank as column ``name``."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, place).filter(F.col(name) <= k)
