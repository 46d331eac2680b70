"""Time the registered queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads. Arguments pick
queries by a part of their name. Every query runs once to the end; the first one
runs once before, uncounted, to start the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from rinkframe.bindings import QUERIES
from rinkframe.session import configure


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    parts = sys.argv[1:]
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rinkframe-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    names = [n for n in QUERIES if not parts or any(p in n for p in parts)]
    run(names[0])
    seconds = {name: run(name) for name in names}
    print(json.dumps({
        "metric": "total query time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
