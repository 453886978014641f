"""Append-only facts: new silver rows joined to orders and customers.

A stream joined to a static side keeps no state and needs no watermark. A row
whose order arrives later keeps its NULLs. :func:`append_fact` joins a snapshot
of all orders; :func:`append_kept_fact` reads only the buckets of kept look-ups
that the new rows touch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.joins import lookup_join
from tidemark.operators.quality import clean_rows
from tidemark.plans.entities import Entity
from tidemark.plans.star import CUSTOMER_COLUMNS, ORDER_FACT_COLUMNS
from tidemark.sources.kept import BUCKETS, KeptTable, newest
from tidemark.streaming.silver import bronze_stream, judged, silver_schema

BATCH = "batch_id"

Fact = Callable[[DataFrame, DataFrame, DataFrame], DataFrame]


def append_fact(
    fact: Fact, rows: DataFrame, orders: DataFrame, customers: DataFrame, target: str, checkpoint: str
) -> StreamingQuery:
    """Start a run that appends the facts of all rows not yet seen, then stops."""
    return (
        fact(rows, orders, customers)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target)
    )


def kept_orders(spark: SparkSession, root: str, entity: Entity, buckets: int = BUCKETS) -> KeptTable:
    """The last purchased row of each order id."""
    schema = silver_schema(spark, entity)
    schema = type(schema)([schema[c] for c in ORDER_FACT_COLUMNS])
    return KeptTable(spark, root, schema, ("order_id",), newest(["order_id"], F.col("order_purchase_date").desc_nulls_last()), buckets)


def kept_customers(spark: SparkSession, root: str, entity: Entity, buckets: int = BUCKETS) -> KeptTable:
    """One row of each customer id, as :func:`tidemark.plans.star.customer_lookup` picks it."""
    schema = silver_schema(spark, entity)
    schema = type(schema)([schema[c] for c in CUSTOMER_COLUMNS])
    return KeptTable(spark, root, schema, ("customer_id",), newest(["customer_id"]), buckets)


def keep_clean(spark: SparkSession, bronze: str, entity: Entity, kept: KeptTable, checkpoint: str) -> StreamingQuery:
    """Start a run that merges the clean rows of new bronze files into a kept look-up, then stops."""

    def each(rows: DataFrame, batch: int) -> None:
        clean = clean_rows(judged(rows, entity))
        kept.upsert(clean.where(" AND ".join(f"`{k}` IS NOT NULL" for k in kept.keys)), batch)

    return (
        bronze_stream(spark, bronze, entity)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(each)
        .start()
    )


def found_orders(rows: DataFrame, orders: KeptTable, customers: KeptTable) -> DataFrame:
    """One row for each order of ``rows`` that is known, with the region of its customer.

    Both look-ups have one row a key, so no window is needed, and only the
    buckets of the rows' orders, then of those orders' customers, are read.
    Other orders of those buckets are dropped before they are shuffled, but not
    if the rows outnumber them: that would shuffle more than it drops.
    """
    ids = rows.select(F.col("order_id").alias("__id")).where("__id IS NOT NULL")
    known = orders.matching(ids, ["__id"])
    if ids.count() < known.count():
        known = known.join(ids.distinct(), F.col("order_id") == F.col("__id"), "left_semi")
    people = customers.matching(known, ["customer_id"]).select("customer_id", F.col("region").alias("region_name"))
    return lookup_join(known, people, "customer_id").select("e.*", "o.region_name")


def append_kept_fact(
    fact: Callable[[DataFrame, DataFrame], DataFrame],
    rows: DataFrame,
    orders: KeptTable,
    customers: KeptTable,
    target: str,
    checkpoint: str,
) -> StreamingQuery:
    """Start a run that appends the facts of all rows not yet seen, then stops.

    ``fact`` makes facts of rows and a look-up, such as
    :func:`tidemark.plans.star.sales_rows`. A batch has a folder of its own
    under ``target``, so a repeated batch replaces it.
    """

    def each(batch: DataFrame, number: int) -> None:
        facts = fact(batch, found_orders(batch, orders, customers))
        facts.write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/{BATCH}={number}")

    return (
        rows.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(each)
        .start()
    )
