"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the local
cores. Every query runs once to warm up and then BENCH_RUNS times; the median
counts. All result rows are produced, none are kept.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tilewright.session import build_session
from workload import QUERIES

HEADLINE = [
    "lob_columns",
    "lob_profile",
    "partition_info",
    "table_report",
    "leading_key",
    "range_boundaries",
    "range_boundaries_ties",
    "range_boundaries_narrowed",
    "load_rules",
    "final_report",
    "assign_slices",
    "slice_balance",
    "compare_tables",
    "compare_rows",
    "compare_lobs",
    "lob_split",
    "sequence_positions",
    "column_stats_sketch",
    "user_databases",
    "user_pg_databases",
    "user_schemas",
    "name_search",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=8 if cpus == "*" else int(cpus),
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    scale = re.search(r"sf([\d.]+)", os.path.basename(sf_dir.rstrip("/")))
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
