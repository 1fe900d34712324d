"""Time the headline queries and print one JSON line.

Each query is run once untimed at first, so that class loading and code generation of the session
are not counted, then timed on the full tables of $BENCH_SF_DIR. Results are consumed by the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "bars_from_ticks",
    "first_bars",
    "ema",
    "adx",
    "parabolic_sar",
    "features_router",
    "signal_features",
    "three_way_labels",
    "mutual_information",
    "synthetic_rows",
    "stratified_folds",
    "roc_auc",
    "unit_root",
    "arima_orders",
    "class_neighbours",
    "streamed_tick_bars",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from barloom.session import open_workspaces, release
    from verification.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="barloom-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - begin
        release(spark, [w for w in open_workspaces(spark) if "stored-bars" in w.folder])
        return took

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(run(name), 3)
    print(
        json.dumps(
            {
                "metric": "headline query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
