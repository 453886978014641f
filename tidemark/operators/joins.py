"""Joins of many rows to a look-up with one row for each key."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "__lookup_key"


def lookup_join(
    rows: DataFrame, lookup: DataFrame, key: str, how: Literal["inner", "left"] = "left"
) -> DataFrame:
    """Join on a text key; columns of the two sides are ``e.*`` and ``o.*``.

    Any share of the rows may carry one key. Spark broadcasts the look-up when
    its measured size allows. Otherwise both sides are shuffled and AQE splits
    the partition of a hot key, but only where a shuffle stands right below
    the join. A look-up that was made by a window over its key is already
    partitioned by it and would get no shuffle, so its key is derived anew
    here. That costs one more shuffle of the smaller side.
    """
    fresh = lookup.withColumn(KEY, F.concat(F.col(key), F.lit("")))
    return rows.alias("e").join(fresh.alias("o"), F.col(f"e.{key}") == F.col(f"o.{KEY}"), how)
