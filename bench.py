"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   input folder (default /root/testdata/sf0.1)
BENCH_CPUS     cores (default 8)
BENCH_RUNS     timed runs per query after a warm-up, of which the median counts (default 2)
BENCH_QUERIES  comma-separated names (default: the headline list below)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from quayside.registry import QUERIES
from quayside.session import build_session

HEADLINE = (
    "pipe_01",
    "pipe_02",
    "pipe_06",
    "pipe_07",
    "pipe_10",
    "pipe_13",
    "pipe_16",
    "pipe_18",
    "pipe_23",
    "pipe_27",
    "pipe_29",
    "pipe_34",
    "agg_01",
    "jn_02",
    "win_02",
    "win_03",
    "arr_01",
)


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "quayside-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(QUERIES[name], spark, sf_dir)  # warm-up
        seconds[name] = round(
            statistics.median(timed(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3
        )
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "headline queries, sum of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
