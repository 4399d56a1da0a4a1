"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the cores. Results are forced with a noop write, so
every row of every column is computed. Each query runs once to warm up and then BENCH_RUNS times;
the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from hirelake.plans import catalog
from hirelake.session import local_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:]
    spark = local_session("hirelake-bench", cores=cpus, shuffle_partitions=int(cpus))
    times = {}
    for name, query in catalog.queries().items():
        if name in catalog.WRITING and not wanted:  # their tables would pile up over the runs; name them to time them
            continue
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            query(spark, folder).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took[1:] or took), 3)
    spark.stop()
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}
        )
    )


if __name__ == "__main__":
    main()
