"""KPI payloads of the marts as JSON, and the insight table built from them.

Each payload is one row. Sums come from one grouping, top lists from
``orderBy`` with ``limit``, so only a handful of rows meet in the last step.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.functions.columns import is_true
from tidemark.operators.exact import money_sum, ratio
from tidemark.operators.scoring import Model, score_prompts
from tidemark.plans.quality_report import utc_now

# List lengths, the high return rate in percent, and insight names.
EXTREME_REGIONS = 3
TOP_VENDORS = 5
TOP_SLOW_REGIONS = 5
HIGH_RATE_PCT = 20.0

# Our own wording.
SUMMARY = "The figures below show where results differ most between regions, vendors and products; start with the extremes."
PROMPT = (
    "Summarise these figures for company leadership in four to six sentences.\nTopic: {insight_type}\n"
    "Figures: {kpi_payload_json}\n"
    "Name the strongest signals, say what they mean for the business and where to look first. "
    "Use no figure that is not given."
)

MONEY = "decimal(20,2)"


def _listed(df: DataFrame, order: list[Column], k: int, point: Column) -> DataFrame:
    """The first ``k`` rows as one array of structs."""
    top = df.orderBy(*order).limit(k)
    return top.agg(F.collect_list(point).alias("points"))


def _points(df: DataFrame, order: list[Column], k: int, point: Column) -> Column:
    return _listed(df, order, k, point).scalar()


def revenue_kpis(monthly: DataFrame) -> DataFrame:
    regions = monthly.groupBy(F.col("region_name").alias("region")).agg(
        money_sum(F.col("total_sales_amount")).alias("revenue")
    )
    point = F.struct("region", F.col("revenue").cast(MONEY).alias("revenue"))
    high = [F.desc_nulls_last("revenue"), F.asc("region")]
    low = [F.asc_nulls_last("revenue"), F.asc("region")]
    return regions.agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).cast(MONEY).alias("total_revenue"),
        F.coalesce(ratio(F.sum("revenue"), F.count("revenue"), 2), F.lit(0.0))
        .cast(MONEY)
        .alias("avg_revenue_per_region"),
        F.count(F.lit(1)).alias("region_count"),
    ).select(
        "total_revenue",
        "avg_revenue_per_region",
        _points(regions, high, EXTREME_REGIONS, point).alias("top_regions"),
        _points(regions, low, EXTREME_REGIONS, point).alias("bottom_regions"),
        "region_count",
    )


def vendor_kpis(vendor_rates: DataFrame) -> DataFrame:
    rate = F.col("return_rate_pct").cast("decimal(18,2)")
    point = F.struct(
        "vendor_name",
        F.coalesce(rate, F.lit(0)).cast(MONEY).alias("return_rate"),
        F.coalesce("total_returns", F.lit(0)).cast("long").alias("total_returns"),
    )
    high = [F.desc_nulls_last("return_rate_pct"), F.asc("vendor_name"), F.asc("vendor_id")]
    return vendor_rates.agg(
        F.coalesce(ratio(F.sum(rate), F.count(rate), 4), F.lit(0.0))
        .cast("decimal(20,4)")
        .alias("avg_vendor_return_rate"),
        F.count_if(F.col("return_rate_pct") >= HIGH_RATE_PCT).alias("high_return_rate_vendor_count_ge_20pct"),
        F.count_distinct("vendor_name").alias("vendor_count"),
    ).select(
        "avg_vendor_return_rate",
        "high_return_rate_vendor_count_ge_20pct",
        _points(vendor_rates, high, TOP_VENDORS, point).alias("top_vendor_return_rates"),
        "vendor_count",
    )


def slow_inventory_by_region(slow: DataFrame) -> DataFrame:
    return (
        slow.filter(is_true(F.col("is_slow_mover")))
        .groupBy(F.col("region_name").alias("region"))
        .agg(
            F.count("product_name").alias("slow_product_count"),
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(money_sum(F.col("total_revenue")), F.lit(0)).cast(MONEY).alias("slow_inventory_value"),
        )
    )


def slow_inventory_kpis(slow: DataFrame) -> DataFrame:
    regions = slow_inventory_by_region(slow)
    point = F.struct("region", "slow_product_count", "slow_inventory_value")
    high = [F.desc("slow_inventory_value"), F.asc("region")]
    return regions.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("slow_moving_product_count"),
        F.coalesce(F.sum("slow_inventory_value"), F.lit(0)).cast(MONEY).alias(
            "total_slow_moving_inventory_value"
        ),
        F.count(F.lit(1)).alias("region_count_with_slow_inventory"),
    ).select(
        "slow_moving_product_count",
        "total_slow_moving_inventory_value",
        _points(regions, high, TOP_SLOW_REGIONS, point).alias("top_regions_by_slow_inventory"),
        "region_count_with_slow_inventory",
    )


def payload_json(kpis: DataFrame) -> DataFrame:
    return kpis.select(F.to_json(F.struct("*")).alias("kpi_payload_json"))


def insight_rows(payloads: Mapping[str, DataFrame]) -> DataFrame:
    """One row for each named payload."""
    rows = [
        payload_json(kpis).select(F.lit(name).alias("insight_type"), "kpi_payload_json")
        for name, kpis in payloads.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def business_insights(payloads: Mapping[str, DataFrame], model: Model | None = None) -> DataFrame:
    """The stored insight table."""
    rows = insight_rows(payloads)
    asked = rows.withColumn("prompt", prompt())
    return score_prompts(asked, "prompt", "executive_summary", F.lit(SUMMARY), model).select(
        "insight_type", "executive_summary", "kpi_payload_json", utc_now().alias("generated_at")
    )


def prompt() -> Column:
    return text.render(PROMPT, {n: F.col(n) for n in ("insight_type", "kpi_payload_json")})


# Our own wording.
REVENUE_QUESTION = "In four sentences or fewer, assess for an executive how revenue differs between these regions and months: "
VENDOR_QUESTION = "Assess briefly what risk these vendors' return rates carry, and name the one action to take first: "
NO_ASSESSMENT = "No assessment was given for this page."


def assessments(pages: DataFrame, question: str, model: Model | None = None) -> DataFrame:
    """Each page of points with the model's assessment of it; pages come from ``paged_points``."""
    asked = pages.withColumn("prompt", F.concat(F.lit(question), "points_json"))
    return score_prompts(asked, "prompt", "assessment", F.lit(NO_ASSESSMENT), model, status="status").drop("prompt")
