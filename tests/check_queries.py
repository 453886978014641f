"""Compare registered queries with their SQL: ``python tests/check_queries.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parents[1])]

import compare  # noqa: E402

from tidemark.session import build_session  # noqa: E402
from tidemark.workload import QUERIES, runnable  # noqa: E402


def main() -> int:
    sf, wanted = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = compare.oracle(folder)
    bad = 0
    for name, q in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = runnable(q.build)(spark, folder)
            fault = f"{df.count()} rows, no SQL" if q.sql is None else compare.mismatch(df, con, q.sql)
        except Exception as error:
            fault = f"{type(error).__name__}: {str(error)[:1500]}"
        ok = fault is None or q.sql is None
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.1f}s {fault or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
