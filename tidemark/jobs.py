"""The whole lakehouse as jobs over named tables.

Each function brings one layer or one report up to date and can run alone:

    lake = Lakehouse(spark, "/landing", "/lake")
    lake.refresh()          # files -> bronze -> silver -> star schema -> marts
    lake.report_quality()   # quarantine tables -> audit report

Transactions, returns and their facts grow by streams. Orders and customers are
kept by key buckets, so new facts read only the buckets they touch, and marts
take in new facts only. Everything else is rewritten in full, to a fresh folder
that a view turns to when it is complete.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordered import stored_in_order
from tidemark.operators import quality
from tidemark.operators.quality import REASON, STAMP, VERDICT
from tidemark.operators.points import PAGE_ROWS, paged_points
from tidemark.operators.scoring import Model
from tidemark.plans import insights, quality_report, retrieval, return_risk, star, term_search
from tidemark.plans.deltas import KeptMarts, follow
from tidemark.plans.entities import ENTITIES
from tidemark.sources import tables
from tidemark.sources.kept import BUCKETS, KeptTable
from tidemark.sources.scratch import exists, new_folder
from tidemark.streaming import bronze, facts, silver

STREAMED = ("transactions", "returns")
FACTS = (("fact_sales", "transactions", star.sales_rows), ("fact_returns", "returns", star.return_rows))
CLEAN_TABLES = {name: f"silver_{name}" for name in ENTITIES} | {"orders": "silver_orders_clean"}


@dataclass
class Lakehouse:
    spark: SparkSession
    landing: str
    root: str
    silver: str = "silver"
    gold: str = "gold"
    # Key buckets of the kept look-ups and marts; a bucket has to fit a task.
    buckets: int = BUCKETS

    # --- layers -----------------------------------------------------------------

    def refresh(self) -> None:
        self.ingest()
        self.refine()
        self.build_star()
        self.build_marts()

    def ingest(self) -> None:
        bronze.ingest_all(self.spark, self.landing, self.root)

    def refine(self) -> dict[str, dict[str, int]]:
        """Clean and quarantine tables of every entity; the rows judged and those that broke each rule."""
        tables.ensure_schema(self.spark, self.silver)
        counts: dict[str, dict[str, int]] = {}
        runs = {
            name: silver.refine(
                self.spark,
                f"{self.root}/bronze/{name}",
                self._silver_path(name),
                f"{self.root}/checkpoints/silver/{name}",
                ENTITIES[name],
            )
            for name in STREAMED
        }
        for name, run in runs.items():
            run.awaitTermination()
            counts[name] = quality.stream_counts(run)
        for name, entity in ENTITIES.items():
            if name not in STREAMED:
                raw, watched = bronze.read_bronze(self.spark, f"{self.root}/bronze/{name}"), Observation()
                split = quality.counted_rules(silver.judged(raw, entity), entity.rules, watched)
                split.write.mode("overwrite").partitionBy(VERDICT).parquet(self._silver_path(name))
                counts[name] = watched.get
            self._view(CLEAN_TABLES[name], name, "clean", f"{VERDICT}, {REASON}, {STAMP}")
            self._view(f"silver_{name}_quarantine", name, "quarantine", VERDICT)
        return counts

    def build_star(self) -> None:
        tables.ensure_schema(self.spark, self.gold)
        self._replace("dim_date", star.dim_date(self.spark))
        self._replace("dim_customer", star.dim_customer(self._clean("customers")))
        self._replace("dim_vendor", star.dim_vendor(self._clean("vendors")))
        self._replace("dim_region", star.dim_region(self._clean("customers")))
        self._replace("dim_product", star.dim_product(self._clean("products")))
        kept = self._kept_lookups()
        for name, table in kept.items():
            facts.keep_clean(
                self.spark, f"{self.root}/bronze/{name}", ENTITIES[name], table, f"{self.root}/checkpoints/gold/kept_{name}"
            ).awaitTermination()
        for name, source, fact in FACTS:
            if not exists(self.spark, self._fact_path(name)):
                # An empty first batch, so that the fact can be read and followed before it has rows.
                empty = self.spark.createDataFrame([], self._fact_schema(name))
                empty.write.mode("overwrite").parquet(f"{self._fact_path(name)}/{facts.BATCH}=-1")
            rows = silver.follow_clean(self.spark, self._silver_path(source), ENTITIES[source])
            facts.append_kept_fact(
                fact, rows, kept["orders"], kept["customers"], self._fact_path(name), f"{self.root}/checkpoints/gold/{name}"
            ).awaitTermination()
            stored = f"SELECT * EXCEPT ({facts.BATCH}) FROM parquet.{tables.quoted(self._fact_path(name))}"
            self._publish(f"{self.gold}.{name}", stored, self.spark.createDataFrame([], self._fact_schema(name)))

    def build_marts(self) -> None:
        """The marts take in the facts that came since the last run."""
        kept, people, days = KeptMarts(self.spark, f"{self.root}/gold/kept_marts", self.buckets), self._kept_lookups()["customers"], self.table("dim_date")

        def add_sales(sales: DataFrame, batch: int) -> None:
            kept.add_sales(sales, days, people.matching(sales, ["customer_id"]), batch)

        for name, add in (("fact_sales", add_sales), ("fact_returns", kept.add_returns)):
            schema = T.StructType([*self._fact_schema(name), T.StructField(facts.BATCH, T.LongType())])
            new = self.spark.readStream.schema(schema).parquet(self._fact_path(name)).drop(facts.BATCH)
            follow(new, add, f"{self.root}/checkpoints/marts/{name}").awaitTermination()
        self._replace("mv_monthly_revenue_by_region", kept.monthly_revenue())
        self._replace("mv_customer_return_history", kept.customer_return_history(star.customer_lookup(self.table("dim_customer"))))
        self._replace("mv_vendor_return_rate", kept.vendor_return_rate(self.table("dim_vendor")))
        self._replace("mv_slow_moving_products", kept.slow_moving_products(self.table("dim_product"), self.table("dim_region")))

    def store_in_order(self, name: str) -> DataFrame:
        """A mart or report with its rank in reading order, stored sorted."""
        return self._replace(f"{name}_in_order", stored_in_order(self.table(name), REPORT_ORDER[name]()))

    # --- reports ----------------------------------------------------------------

    def report_quality(self, model: Model | None = None) -> DataFrame:
        first = [f"{self.silver}.silver_{name}_quarantine" for name in ENTITIES]
        found = tables.find_tables(self.spark, self.silver, first)
        if not found:
            raise ValueError(f"no quarantine tables in {self.silver}")
        # Two passes read the rejects, so they are exploded and hashed once.
        folder = new_folder(self.spark, "rejects")
        quality_report.all_rejects(tables.read_tables(self.spark, found)).write.parquet(folder)
        rejects = self.spark.read.parquet(folder)
        report = quality_report.audit_report(quality_report.grouped_report(rejects), model)
        return self._replace("dq_audit_report", report)

    def report_risk(self, model: Model | None = None) -> DataFrame:
        profile = return_risk.profiles(self.table("fact_returns"))
        scores = return_risk.scored(return_risk.with_customers(profile, self.table("dim_customer")))
        return self._replace("flagged_return_customers", return_risk.flagged_customers(scores, model))

    def answer(self, questions: list[str], k: int = retrieval.TOP_K, model: Model | None = None) -> DataFrame:
        """Answer questions from product and vendor documents and add them to the query log."""
        products = retrieval.product_documents(
            self.table("dim_product"),
            self.table("mv_slow_moving_products"),
            self.table("mv_monthly_revenue_by_region"),
        )
        vendors = retrieval.vendor_documents(self.table("dim_vendor"), self.table("mv_vendor_return_rate"))
        documents = self._replace("rag_documents", retrieval.all_documents(products, vendors))
        asked = self.spark.createDataFrame(
            list(enumerate(questions)), "question_id int, question string"
        )
        weights, idf = term_search.document_weights(documents, "doc_id", "doc_text")
        found = term_search.retrieve_by_terms(asked, documents, weights, idf, k)
        log = f"{self.gold}.rag_query_history"
        tables.extend_table(retrieval.answers(retrieval.contexts(found), k, model), log)
        return self.spark.read.table(log)

    def report_insights(self, model: Model | None = None) -> DataFrame:
        payloads = {
            "revenue_performance": insights.revenue_kpis(self.table("mv_monthly_revenue_by_region")),
            "vendor_return_rate": insights.vendor_kpis(self.table("mv_vendor_return_rate")),
            "slow_moving_inventory": insights.slow_inventory_kpis(self.table("mv_slow_moving_products")),
        }
        return self._replace("ai_business_insights", insights.business_insights(payloads, model))

    def report_assessments(self, model: Model | None = None, page_rows: int = PAGE_ROWS) -> DataFrame:
        """Assessments of regional revenue and of vendors' return rates, one for each page of points."""
        text_of = {
            "revenue": (insights.REVENUE_QUESTION, "mv_monthly_revenue_by_region", {"region": "region_name", "revenue": "total_sales_amount"}),
            "vendor_return_rate": (insights.VENDOR_QUESTION, "mv_vendor_return_rate", {"vendor_name": "vendor_name", "return_rate": "return_rate_pct"}),
        }
        parts = []
        for name, (question, mart, fields) in text_of.items():
            pages = paged_points(self.table(mart), {n: F.col(c) for n, c in fields.items()}, page_rows)
            parts.append(insights.assessments(pages, question, model).select(F.lit(name).alias("assessment_type"), "*"))
        return self._replace("ai_assessments", parts[0].unionByName(parts[1]))

    # --- tables -----------------------------------------------------------------

    def table(self, name: str) -> DataFrame:
        return self.spark.read.table(f"{self.gold}.{name}")

    def _clean(self, name: str) -> DataFrame:
        return self.spark.read.table(f"{self.silver}.{CLEAN_TABLES[name]}")

    def _silver_path(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def _fact_path(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def _fact_schema(self, name: str) -> T.StructType:
        """Columns of a fact, known before any row is stored."""
        _, source, fact = next(f for f in FACTS if f[0] == name)
        lookups = self._kept_lookups()
        columns = T.StructType([*lookups["orders"].schema, T.StructField("region_name", T.StringType())])
        none = self.spark.createDataFrame([], columns)
        return fact(self._clean(source).limit(0), none).schema

    def _kept_lookups(self) -> dict[str, KeptTable]:
        return {
            name: make(self.spark, f"{self.root}/gold/kept_{name}", ENTITIES[name], self.buckets)
            for name, make in (("orders", facts.kept_orders), ("customers", facts.kept_customers))
        }

    def _replace(self, name: str, df: DataFrame) -> DataFrame:
        tables.refresh_table(df, f"{self.gold}.{name}", f"{self.root}/tables/{name}")
        return self.table(name)

    def _view(self, view: str, name: str, verdict: str, dropped: str) -> None:
        schema = silver.silver_schema(self.spark, ENTITIES[name])
        path = self._silver_path(name)
        rows = f"SELECT * EXCEPT ({dropped}) FROM parquet.{tables.quoted(path)} WHERE {VERDICT} = '{verdict}'"
        empty = self.spark.createDataFrame([], schema).drop(*dropped.split(", "))
        self._publish(f"{self.silver}.{view}", rows, empty)

    def _publish(self, name: str, rows: str, empty: DataFrame) -> None:
        """A view over streamed files, or an empty table until the first rows arrive."""
        catalog = self.spark.catalog
        if catalog.tableExists(name) and catalog.getTable(name).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {name}")
        try:
            self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {rows}")
        except AnalysisException as error:
            # Any other fault must not pass for a table without rows.
            if not _no_files_yet(error):
                raise
            tables.replace_table(empty, name)


def _no_files_yet(error: AnalysisException) -> bool:
    """Whether a folder is missing, empty, or a stream's table without files; the last has no named condition."""
    named = error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
    return named or str(error).startswith("Unable to infer schema")


# The order each mart and report is read in.
REPORT_ORDER: dict[str, Callable[[], list[Column]]] = {
    "mv_monthly_revenue_by_region": lambda: [F.asc("year"), F.asc("month_num"), F.asc("region_name")],
    "mv_customer_return_history": lambda: [F.desc("total_returns")],
    "mv_vendor_return_rate": lambda: [F.desc("return_rate_pct")],
    "mv_slow_moving_products": lambda: [F.desc("is_slow_mover"), F.desc("days_since_last_sale")],
    "dq_audit_report": lambda: [F.desc("rejected_count")],
    "flagged_return_customers": lambda: [F.desc("anomaly_score")],
    "ai_business_insights": lambda: [F.asc("insight_type")],
    "rag_query_history": lambda: [F.desc("generated_at")],
}


def in_report_order(mart: DataFrame, name: str) -> DataFrame:
    """Rows of a mart or report in the order it is read in."""
    return mart.orderBy(*REPORT_ORDER[name]())
