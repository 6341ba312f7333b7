"""Benchmark the headline queries.

Runs each query fully (``noop`` sink: every row computed, nothing collected)
at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints one JSON line with the median wall time per query over
``$BENCH_RUNS`` warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "compact_latest",
    "enriched_reviews",
    "adaptive_metrics",
    "metric_by_app",
    "page_explode",
    "contract_check",
    "load_watermarks",
    "incremental_upsert",
    "dq_not_null",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE

    from reviewforge.session import build_session

    scratch = tempfile.mkdtemp(prefix="rf-bench-")
    spark = build_session(
        f"local[{cpus}]",
        app_name="reviewforge-bench",
        shuffle_partitions=int(cpus) * 2,
        extra={
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
            "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
            # single machine: keep every core busy after a shuffle
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from reviewforge.plans.queries import QUERIES

    def run_once(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        elapsed = time.perf_counter() - t0
        spark.catalog.clearCache()  # drop this run's persisted side tables (untimed)
        return elapsed

    run_once(names[0])  # JVM warm-up
    results = {}
    for name in names:
        times = [run_once(name) for _ in range(runs)]
        results[name] = round(statistics.median(times), 3)

    # Production path: silver and gold are written tables (as the pipeline
    # leaves them); time the gold rebuild from silver and the metric queries
    # over gold, i.e. the queries the reference's latency target is about.
    if not sys.argv[1:]:
        from reviewforge.operators import metrics, semantic
        from reviewforge.plans.queries import BASE_PARAMS, silver

        silver_path = os.path.join(scratch, "silver")
        gold_path = os.path.join(scratch, "gold")
        silver(spark, sf_dir).write.mode("overwrite").parquet(silver_path)
        metrics.adaptive_metrics(spark.read.parquet(silver_path), BASE_PARAMS).write.mode("overwrite").parquet(
            gold_path
        )

        def gold_from_silver():
            g = metrics.adaptive_metrics(spark.read.parquet(silver_path), BASE_PARAMS)
            g.write.format("noop").mode("overwrite").save()

        def metric_query():
            g = spark.read.parquet(gold_path)
            semantic.query_metrics(g, ["avg_rating", "edp_current", "decay_ewrr", "cult_score"], ["snapshot_date"]).collect()

        for name, fn in (("gold_from_silver_table", gold_from_silver), ("metric_query_on_gold_table", metric_query)):
            fn()
            times = []
            for _ in range(max(runs, 5)):
                t0 = time.perf_counter()
                fn()
                times.append(time.perf_counter() - t0)
            results[name] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
