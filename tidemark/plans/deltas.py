"""Marts kept by deltas: stored sums and counts of each group take in the facts of each new batch.

Sums, counts and maxima of two batches add up. Distinct orders do not, so a
second table keeps the orders of each group, and only those that it does not
hold yet count. Both tables are kept by key buckets: a batch rewrites the
buckets of its own groups, reads those of its orders and writes the new orders
beside them, and never reads the facts before it. Measures are summed straight
into their groups; only the pairs of group and order are shuffled one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.exact import amount
from tidemark.operators.joins import lookup_join
from tidemark.plans import marts
from tidemark.sources.kept import BUCKETS, KeptTable
from tidemark.sources.scratch import new_folder, remove

EXACT = "decimal(38,6)"
FRESH = "orders"
# Columns of the facts that the marts take in.
SALES_COLUMNS = (
    "order_id", "customer_id", "vendor_id", "product_id", "region_name", "date_key", "sales_amount", "quantity", "profit", "discount",
)
RETURNS_COLUMNS = ("order_id", "customer_id", "vendor_id", "refund_amount", "days_to_return", "is_approved", "return_date")


@dataclass(frozen=True)
class Groups:
    """Groups of facts: typed keys, measures that add up, and the column whose values count once in a group."""

    keys: Mapping[str, str]
    sums: Mapping[str, tuple[str, Column]] = field(default_factory=dict)
    maxima: Mapping[str, tuple[str, Column]] = field(default_factory=dict)
    once: str | None = None

    def _totals(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        names = [*self.sums, *([FRESH] if FRESH in rows.columns else [])]
        added = [F.sum(n).cast(self._type(n)).alias(n) for n in names]
        return rows.groupBy(*keys).agg(*added, *[F.max(n).alias(n) for n in self.maxima])

    def _type(self, name: str) -> str:
        return "long" if name == FRESH else {**self.sums, **self.maxima}[name][0]

    def _schema(self, columns: list[str]) -> T.StructType:
        def of(name: str) -> str:
            return self.keys[name] if name in self.keys else "string" if name == self.once else self._type(name)

        return T.StructType.fromDDL(", ".join(f"`{c}` {of(c)}" for c in columns))

    def columns(self) -> list[str]:
        return [*self.keys, *self.sums, *self.maxima, *([FRESH] if self.once else [])]


@dataclass
class KeptGroups:
    """The stored sums and counts of :class:`Groups` under ``root``."""

    spark: SparkSession
    root: str
    groups: Groups
    buckets: int = BUCKETS

    def __post_init__(self) -> None:
        g, keys = self.groups, list(self.groups.keys)
        self.totals = KeptTable(
            self.spark, f"{self.root}/totals", g._schema(g.columns()), tuple(keys), lambda rows: g._totals(rows, keys), self.buckets
        )
        self.seen = self.pairs = None
        if g.once:
            pair = (*keys, g.once)
            self.seen = self.pairs = KeptTable(self.spark, f"{self.root}/seen", g._schema(list(pair)), pair, None, self.buckets)

    def holds(self, batch: int) -> bool:
        """Whether the batch has been taken in."""
        return self.totals.holds(batch) and (self.seen is None or self.seen.holds(batch))

    def add(self, facts: DataFrame, batch: int) -> None:
        """Take in the facts of a batch, which are read more than once; a repeated batch changes nothing."""
        if self.holds(batch):
            return
        g, keys = self.groups, list(self.groups.keys)
        measures = [how.cast(kind).alias(n) for n, (kind, how) in {**g.sums, **g.maxima}.items()]
        rows = facts.select(*keys, *measures)
        if self.pairs is None:
            self.totals.upsert(g._totals(rows, keys), batch)
            return
        folder = new_folder(self.spark, "fresh")
        fresh = self.pairs.write(self._fresh(facts), folder)
        counted = fresh.select(*keys, F.lit(1).cast("long").alias(FRESH))
        both = rows.withColumn(FRESH, F.lit(0).cast("long")).unionByName(counted, allowMissingColumns=True)
        # The totals go first: until the pairs are stored as well, a repeated batch finds them as they were.
        # Their merge adds up the facts themselves, beside the old sums.
        self.totals.upsert(both, batch, folder)
        self.seen.upsert(fresh, batch, folder)
        remove(self.spark, folder)

    def _fresh(self, facts: DataFrame) -> DataFrame:
        """The pairs of group and order that are not stored yet, each once."""
        grain = [*self.groups.keys, self.groups.once]
        typed = [F.col(n).cast(self.groups.keys.get(n, "string")).alias(n) for n in grain]
        pairs = facts.where(F.col(self.groups.once).isNotNull()).select(*typed)
        known = self.seen.matching(pairs).select(*grain, F.lit(True).alias("__known"))
        both = pairs.withColumn("__known", F.lit(False)).unionByName(known)
        return both.groupBy(*grain).agg(F.max("__known").alias("__known")).where(~F.col("__known")).select(*grain)

    def read(self) -> DataFrame:
        return self.totals.read()


def _exact(name: str) -> tuple[str, Column]:
    return EXACT, amount(F.col(name))


def _count(condition: Column) -> tuple[str, Column]:
    return "long", F.when(condition, 1).otherwise(0)


def _present(name: str) -> tuple[str, Column]:
    return _count(F.col(name).isNotNull())


def month_groups() -> Groups:
    return Groups(
        {"year": "int", "month_num": "int", "month_name": "string", "quarter": "int", "region_name": "string", "country": "string"},
        {"sales": _exact("sales_amount"), "quantity": ("long", F.col("quantity")), "profit": _exact("profit"), "discount": _exact("discount")},
        once="order_id",
    )


def customer_groups() -> Groups:
    returned = F.try_to_timestamp("return_date").cast("date")
    return Groups(
        {"customer_id": "string"},
        {
            "returns": _present("order_id"), "refund": _exact("refund_amount"), "refunds": _present("refund_amount"),
            "days": ("long", F.col("days_to_return")), "dated": _present("days_to_return"),
            "approved": _count(F.coalesce(F.col("is_approved"), F.lit(False))),
        },
        {"last_return_date": ("date", returned)},
    )


def vendor_sold_groups() -> Groups:
    return Groups({"vendor_id": "string"}, {"revenue": _exact("sales_amount")}, once="order_id")


def vendor_back_groups() -> Groups:
    return Groups(
        {"vendor_id": "string"},
        {
            "returns": _present("order_id"), "refund": _exact("refund_amount"),
            "days": ("long", F.col("days_to_return")), "dated": _present("days_to_return"),
        },
    )


def product_groups() -> Groups:
    return Groups(
        {"product_id": "string", "region_name": "string"},
        {"units": ("long", F.col("quantity")), "revenue": _exact("sales_amount")},
        {"last_sale_date": ("date", F.col("full_date"))},
        once="order_id",
    )


class KeptMarts:
    """The four marts under ``root``, each from sums and counts that take in new facts only.

    A sale keeps the country that its customer had when the sale came in.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark

        def kept(name: str, groups: Groups) -> KeptGroups:
            return KeptGroups(spark, f"{root}/{name}", groups, buckets)

        self.months = kept("months", month_groups())
        self.customers = kept("customers", customer_groups())
        self.sold = kept("vendor-sold", vendor_sold_groups())
        self.back = kept("vendor-back", vendor_back_groups())
        self.products = kept("products", product_groups())

    def add_sales(self, facts: DataFrame, dim_date: DataFrame, customers: DataFrame, batch: int) -> None:
        """Take in new sales; ``customers`` has one row for each id of theirs, more do not matter."""
        placed = facts.filter("date_key IS NOT NULL AND region_name IS NOT NULL")
        days = dim_date.select("date_key", "full_date", "year", "month_num", "month_name", "quarter")
        if not self.months.holds(batch):
            # The join to the customers is made once; what follows reads its rows. Days are added behind its shuffle.
            homes, folder = customers.select("customer_id", "country"), new_folder(self.spark, "placed")
            measures = ("order_id", "sales_amount", "quantity", "profit", "discount")
            sold = placed.select("customer_id", "date_key", "region_name", *measures)
            at_home = lookup_join(sold, homes, "customer_id", "inner").select("e.*", "o.country")
            at_home.drop("customer_id").write.option("compression", "zstd").parquet(folder)
            self.months.add(self.spark.read.parquet(folder).join(days, "date_key"), batch)
            remove(self.spark, folder)
        self.sold.add(facts, batch)
        self.products.add(placed.join(days, "date_key"), batch)

    def add_returns(self, facts: DataFrame, batch: int) -> None:
        self.customers.add(facts.filter("customer_id IS NOT NULL"), batch)
        self.back.add(facts, batch)

    def monthly_revenue(self) -> DataFrame:
        return marts.monthly_revenue_of(self.months.read())

    def customer_return_history(self, customers: DataFrame) -> DataFrame:
        return marts.customer_history_of(self.customers.read(), customers)

    def vendor_return_rate(self, dim_vendor: DataFrame) -> DataFrame:
        return marts.vendor_rate_of(self.sold.read(), self.back.read(), dim_vendor)

    def slow_moving_products(
        self, dim_product: DataFrame, dim_region: DataFrame, as_of: Column | None = None, include_unsold: bool = False
    ) -> DataFrame:
        return marts.slow_products_of(self.products.read(), dim_product, dim_region, as_of, include_unsold)


def follow(facts: DataFrame, add: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Start a run that gives every batch of new facts to ``add``, then stops."""
    return (
        facts.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(add)
        .start()
    )
