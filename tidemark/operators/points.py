"""Rows of a report folded into JSON text for a prompt."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import RANK, stored_in_order

# Points of one prompt.
PAGE_ROWS = 500


def points_json(df: DataFrame, fields: Mapping[str, Column], key: Column, page_digits: int = 0) -> DataFrame:
    """``page, point_count, points_json``: the rows as sorted JSON arrays.

    Rows are dealt to ``16 ** page_digits`` pages by a hash of ``key``, and each
    page is one text. Zero digits put a whole report into a single text, which
    only suits one whose size is bounded, such as region months.
    """
    point = F.struct(*[c.cast("string").alias(n) for n, c in fields.items()])
    page = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, page_digits)
    return (
        df.select(page.alias("page"), point.alias("point"))
        .groupBy("page")
        .agg(
            F.count(F.lit(1)).alias("point_count"),
            F.to_json(F.array_sort(F.collect_list("point"))).alias("points_json"),
        )
    )


def paged_points(df: DataFrame, fields: Mapping[str, Column], page_rows: int = PAGE_ROWS) -> DataFrame:
    """``page, point_count, points_json``: all rows in order as JSON arrays of at most ``page_rows`` points.

    Points are ordered by their fields over the whole report. Page numbers come
    from ranks that are counted range by range, so no page exceeds its size
    whatever the rows have in common, and no task sees a whole report.
    """
    points = df.select(*[c.cast("string").alias(n) for n, c in fields.items()])
    placed = stored_in_order(points, [F.col(f"`{n}`").asc_nulls_first() for n in fields])
    page = F.floor((F.col(RANK) - 1) / F.lit(page_rows)).cast("long") + 1
    entry = F.struct(RANK, F.struct(*[F.col(f"`{n}`") for n in fields]).alias("point"))
    listed = placed.groupBy(page.alias("page")).agg(
        F.count(F.lit(1)).alias("point_count"), F.array_sort(F.collect_list(entry)).alias("entries")
    )
    return listed.select("page", "point_count", F.to_json(F.transform("entries", lambda e: e["point"])).alias("points_json"))
