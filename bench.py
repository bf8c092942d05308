"""Times the registered queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, default all), BENCH_RUNS (default 1).
Every query is run once before timing a small set to warm the JVM; results are
written to the no-op sink, so all rows are computed and none are collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from vitrine.catalog import queries
from vitrine.session import build_session


def run(query, spark, folder: str) -> float:
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES")
    registered = queries()
    names = chosen.split(",") if chosen else list(registered)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.vitrine.inputPartitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for warm_up in ("market_overview", "staged_products"):
        run(registered[warm_up], spark, folder)
    seconds = {}
    for name in names:
        seconds[name] = round(statistics.median(run(registered[name], spark, folder) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
