"""Time a trusted step: all columns of lineitem trimmed, the dataset replaced."""

from __future__ import annotations

import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratalake import run_raw, run_trusted  # noqa: E402

RUNS = 5


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    root = tempfile.mkdtemp(prefix="stratalake-bench-")
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    layers = {"landing": sf_dir, "raw": f"{root}/raw", "trusted": f"{root}/trusted"}
    job = {
        "job_name": "lineitem",
        "source": {"type": "parquet", "path": "lineitem.parquet"},
        "destination": {
            "path": "lineitem",
            "trusted": {
                "ingest_type": "Replace",
                "transformations": [{"name": "Trim", "parameters": [{"column_name": "*"}]}],
            },
        },
    }
    run_raw(spark, job, layers, "20240101")

    def timed(work) -> float:
        work()
        seconds = []
        for _ in range(RUNS):
            start = time.perf_counter()
            work()
            seconds.append(time.perf_counter() - start)
        return round(statistics.median(seconds), 3)

    print("trusted step", timed(lambda: run_trusted(spark, job, layers, "20240101")))
    spark.stop()


if __name__ == "__main__":
    main()
