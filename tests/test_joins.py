from contextlib import contextmanager

from pyspark.sql import functions as F

from tidemark.operators.joins import lookup_join
from tidemark.operators.keyed import one_per_key

# Sizes at which this small data counts as large.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50000",
    "spark.sql.shuffle.partitions": "8",
}


@contextmanager
def settings(spark, values):
    before = {n: spark.conf.get(n, None) for n in values}
    for n, v in values.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_a_key_with_a_third_of_the_rows_is_split(spark):
    text = F.col("id").cast("string")
    rows = spark.range(0, 120_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(text).alias("order_id"), F.sha2(text, 256).alias("v"))
    orders = spark.range(120_000).select(F.when(F.col("id") == 0, "hot").otherwise(text).alias("order_id"), F.col("id").alias("n"))
    with settings(spark, LARGE):
        for how in ("left", "inner"):
            joined = lookup_join(rows, one_per_key(orders, ["order_id"]), "order_id", how).select("e.v", "o.n")
            assert len(joined.collect()) == 120_000
            assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()


def test_unknown_and_null_keys_are_kept_by_a_left_join(spark):
    rows = spark.createDataFrame([("a",), ("x",), (None,)], "k string")
    lookup = spark.createDataFrame([("a", 1), (None, 2)], "k string, n int")
    out = lookup_join(rows, lookup, "k").select("e.k", F.col("o.k").alias("ok"), "o.n")
    assert {tuple(r) for r in out.collect()} == {("a", "a", 1), ("x", None, None), (None, None, None)}
    assert lookup_join(rows, lookup, "k", "inner").count() == 1
