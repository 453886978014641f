"""Time the headline queries and print one JSON line.

Each query first runs untimed on the smallest tables, when they lie beside the
timed ones, so that the JVM's warm-up is not part of the first numbers.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.session import build_session  # noqa: E402
from tidemark.workload import QUERIES, runnable  # noqa: E402

HEADLINE = (
    "mv_monthly_revenue_by_region",
    "mv_customer_return_history",
    "mv_vendor_return_rate",
    "mv_slow_moving_products",
    "fact_sales",
    "fact_returns",
    "silver_customers_clean",
    "silver_orders_clean",
    "silver_transactions_clean",
    "silver_transactions_quarantine",
    "dq_audit_report",
    "return_risk_scores",
    "flagged_return_customers",
    "product_documents",
    "vector_top_k",
    "text_vectors",
    "business_insights",
    "fact_sales_stream",
    "bronze_csv_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE

    def seconds(name: str, folder: str) -> float:
        start = time.perf_counter()
        runnable(QUERIES[name].build)(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    times = {}
    for name in wanted:
        if os.path.isdir(small):
            seconds(name, small)
        times[name] = round(seconds(name, folder), 3)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
