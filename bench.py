"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8)
the local threads. Every query runs from the source tables to a full result; nothing is
shared between queries.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weekloom.registry.queries import QUERIES  # noqa: E402
from weekloom.sources.staging import drop_staged  # noqa: E402

HEADLINES = [
    "impute_weekly",
    "impute_segments",
    "run_ingestion",
    "build_features",
    "scale_features",
    "sequence_windows",
    "baseline_metrics",
    "seasonal_ar",
    "decomposition",
    "forecast_metrics",
    "leaderboard",
    "select_best",
    "final_forecast",
    "ensemble_validation",
    "backtest_closed",
    "gbt_fit",
    "recursive_gbt",
    "seq_linear",
    "recursive_seq",
    "evaluate_models",
    "final_forecast_all",
    "backtest_gbt",
    "forecast_for_state",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder_of_run = tempfile.mkdtemp(prefix="weekloom-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("weekloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", folder_of_run)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()
    times = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        drop_staged(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()
    shutil.rmtree(folder_of_run, ignore_errors=True)


if __name__ == "__main__":
    main()
