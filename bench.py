"""Times the headline queries and prints one JSON line.

`BENCH_SF_DIR` names the tables (default sf0.1), `BENCH_CPUS` the local cores
(default 8), `BENCH_RUNS` the timed runs of which the median counts (default 3,
after one warm-up). The merges are also timed in the shape of two joins per step and a
single output task, as ``<query>:two_joins``; ``--alone`` leaves that out.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.plans.queries import QUERIES  # noqa: E402

HEADLINE = (
    "landing_scan",
    "row_hash_delimited",
    "dedupe_batch",
    "classify_changes",
    "classify_changes_orders",
    "scd1_merge",
    "scd1_merge_partitioned",
    "scd2_merge",
    "scd2_merge_orders",
    "scd2_merge_table",
    "scd2_merge_partitioned",
    "scd2_merge_partitioned_orders",
    "ingest_job",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        # no Python stack traces per column call: plans are built several times faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, query, sf_dir: str, runs: int) -> float:
    """Median time to run the query and to produce every value of its result."""
    taken = []
    for n in range(runs + 1):
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        if n:
            taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    chosen = {name: QUERIES[name] for name in HEADLINE}
    if "--alone" not in sys.argv[1:]:
        from benchmarks.two_joins import TWO_JOINS

        chosen |= TWO_JOINS
        # each next to its counterpart, so that both find the JVM alike
        chosen = {name: chosen[name] for name in sorted(chosen)}
    times = {name: seconds(spark, query, sf_dir, runs) for name, query in chosen.items()}
    total = round(sum(times[name] for name in HEADLINE), 4)
    report = {
        "metric": "scd_queries_total_median_seconds",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(report), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
