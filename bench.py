"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the folder of tables, BENCH_CPUS the number of local cores. Each table is first dealt to as many files as
there are cores, which is not timed: the given ones are single files of one row group that no reader can split, unlike
any large table.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from recordloom.checks.queries import QUERIES
from recordloom.session import local_session

HEADLINE = (
    "bundle_flatten_customer",
    "bundle_flatten_lineitem",
    "record_hash_orders",
    "dedup_first_extraction",
    "changes_new_or_changed",
    "scd2_first_load",
    "scd2_merge_run",
    "scd2_rebuild_orders",
    "scd2_apply_two_batches",
    "scd2_apply_in_order",
    "dim_condition",
    "fact_encounter",
    "fact_observation",
    "patient_summary",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").selectExpr("max(o_orderdate)").collect()  # start the JVM

    tables = tempfile.mkdtemp(prefix="bench-")
    for name in ("customer", "orders", "lineitem", "part"):
        rows = spark.read.parquet(f"{folder}/{name}.parquet")
        rows.repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{tables}/{name}.parquet")

    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
