"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the task slots.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from larkspur.plans import catalog  # noqa: E402

HEADLINE = [
    "csv_scan_typed", "libsvm_scan", "drop_missing", "prepared_and_scaled",
    "logistic_predictions", "forest_predictions", "training_history", "selected_features",
    "benchmark_summary", "wide_benchmark", "accuracy", "cross_entropy", "array_predictions", "epoch_order",
    "mini_batches", "sgd_epochs", "plateau_rates", "cluster_usage", "pod_usage", "top_pods",
    "streamed_usage", "point_stream_copy",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "16g")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="larkspur-"))
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:] or HEADLINE
    # Start the JVM's and the Python workers' machinery before the clock runs.
    catalog.QUERIES["accuracy"](spark, folder).collect()
    catalog.QUERIES["array_predictions"](spark, folder).collect()
    seconds = {}
    for name in only:
        began = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    # The fit and test of the published shape alone: its vectors are staged before its clock starts.
    wide = catalog.wide_run(spark, folder).first().asDict()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                      "wide_fit_and_test": {k: round(v, 3) if isinstance(v, float) else v for k, v in wide.items()}}))
    spark.stop()


if __name__ == "__main__":
    main()
