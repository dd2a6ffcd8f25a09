"""Time the headline queries; print one JSON line.

BENCH_SF_DIR   folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or "all"
BENCH_NAIVE    1 adds the naive plan shapes from benchmarks/naive.py
"""

import json
import os
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "tick_calibration",
    "time_zero_window",
    "edge_pairing",
    "ordered_hit_slots",
    "ordered_hits",
    "plane_coincidence",
    "charge_asymmetry",
    "hist2d",
    "cdf_curve",
    "interval_lookup",
    "drift_length",
    "track_extrapolation",
    "strip_chain_slots",
    "strip_position",
    "detector_join",
    "resolution",
)


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    from hitframe.session import drop_scratch
    from hitframe.workloads.catalog import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("hitframe-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SCRATCH", os.path.abspath("spark-warehouse/_bench")))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {n: (lambda q=QUERIES[n]: q(spark, sf_dir)) for n in names}
    if os.environ.get("BENCH_NAIVE") == "1":
        from benchmarks.naive import NAIVE

        runs |= {f"naive_{n}": (lambda q=q: q(spark, sf_dir)) for n, q in NAIVE.items()}
    # first pass warms the JVM and the generated code, the best of two counts
    times = {}
    for name, run in runs.items():
        timed(run)
        times[name] = round(min(timed(run), timed(run)), 3)
        drop_scratch(spark)
    headline = {n: t for n, t in times.items() if not n.startswith("naive_")}
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(headline.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
