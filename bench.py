"""

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and forced with a ``noop`` write (so no parsing is
pruned); a model query's fit runs while it is built and is timed with it.
Reports the median of ``BENCH_RUNS`` timed runs (default 5) after one
warm-up.  Prints one JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "parse_delimited", "parse_fixed_width", "load_update_single", "load_update_composite",
    "duplicate_keys", "load_full", "ols_multi", "forest_tree_nodes", "logit_predict",
]
EXTRA = ["rejected_lines", "load_sequence", "pk_violations", "delivery_plan", "governed_load",
         "governed_load_bucketed", "governed_load_twice", "skip_lines"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = HEADLINE + ([] if os.environ.get("BENCH_HEADLINE_ONLY") else EXTRA)

    from loadwright.registry import QUERIES, table
    from loadwright.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="loadwright-bench")
    results, rates = {}, {}
    for name in names:
        fn = QUERIES[name]

        def once():
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once()  # warm-up
        results[name] = round(statistics.median(once() for _ in range(runs)), 4)
    for name, tbl in (("parse_delimited", "orders"), ("parse_fixed_width", "part")):
        if name in results:
            rates[name] = round(table(spark, sf_dir, tbl).count() / results[name], 1)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 4),
        "unit": "sec",
        "queries": results,
        "parse_rows_per_sec": rates,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "config": {"master": f"local[{cpus}]", "spark": spark.version, "runs": runs,
                   "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                   "driver_memory": spark.conf.get("spark.driver.memory")},
    }))


if __name__ == "__main__":
    main()
