"""Times the headline queries and prints one JSON line.

Settings: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (timed
runs per query, after one untimed run). A time covers the query call, with the
writes it makes, and the computation of every result row and column. The wire
documents and the stored layers that queries read are made before.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from claimstrata.registry import queries as registry
from claimstrata.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "flatten_wire",
    "mask_fields",
    "bronze",
    "silver",
    "policy_metrics",
    "enrich_policy_metrics",
    "enrich_rows",
    "total_customers",
    "dist_age_group",
    "dist_channel",
    "dist_city",
    "monthly_revenue",
    "monthly_slice",
    "csv_rows",
    "published_rows",
)


def seconds(spark, query) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.shuffle.partitions", CPUS)
    start = time.perf_counter()
    registry.bronze_layer(spark, SF_DIR)
    prepared = time.perf_counter() - start
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        query = registry.QUERIES[name]
        seconds(spark, query)
        times[name] = round(statistics.median(seconds(spark, query) for _ in range(RUNS)), 3)
    result = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "prepare_sec": round(prepared, 3),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
