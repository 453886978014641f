"""Bronze batches to silver rows, clean and quarantined, in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.quality import VERDICT, clean_rows, counted_rules, split_by_rules
from tidemark.plans.entities import Entity
from tidemark.plans.silver import STANDARDISE
from tidemark.streaming.bronze import bronze_schema


def bronze_stream(spark: SparkSession, bronze: str, entity: Entity) -> DataFrame:
    return spark.readStream.schema(bronze_schema(entity)).parquet(bronze).drop("batch_id")


def judged(raw: DataFrame, entity: Entity) -> DataFrame:
    """Standardised rows with their verdict."""
    return split_by_rules(STANDARDISE[entity.name](raw), entity.rules, entity.first_failure)


def refine(
    spark: SparkSession, bronze: str, silver: str, checkpoint: str, entity: Entity
) -> StreamingQuery:
    """Standardise new bronze rows and append them to ``silver``, split by verdict.

    The same pass counts the rows that break each rule, for
    :func:`tidemark.operators.quality.stream_counts`.
    """
    return (
        counted_rules(judged(bronze_stream(spark, bronze, entity), entity), entity.rules)
        .writeStream.format("parquet")
        .partitionBy(VERDICT)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(silver)
    )


def silver_schema(spark: SparkSession, entity: Entity) -> T.StructType:
    """Columns of the stored rows, known before any row is stored."""
    empty = spark.createDataFrame([], bronze_schema(entity))
    return judged(empty, entity).schema


def follow_clean(spark: SparkSession, silver: str, entity: Entity) -> DataFrame:
    """Stream of clean rows; the partition column keeps quarantined files unread."""
    return clean_rows(spark.readStream.schema(silver_schema(spark, entity)).parquet(silver))
