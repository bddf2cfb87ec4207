"""Times every registered query; prints one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local cores, BENCH_RUNS the
number of timed runs, of which the fastest counts. The log is landed as files first; that time
is given apart.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import fixtures
from checks.queries import QUERIES


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("clickstream-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    fixtures.landed_lines(spark, sf_dir)
    fixtures.landed_kafka(spark, sf_dir)
    landing = time.perf_counter() - start

    seconds = {}
    for name, query in QUERIES.items():
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    result = {
        "metric": "total seconds of all queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "landing_sec": round(landing, 3),
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
