"""Table profile: row count and NULLs by column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, table: str, max_columns: int | None = None) -> DataFrame:
    """One row for each column, or for the first ``max_columns``, from one scan."""
    names = df.columns[:max_columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names],
    )
    return counts.unpivot("row_count", names, "column_name", "null_count").select(
        F.lit(table).alias("table_name"), "column_name", "row_count", "null_count"
    )
