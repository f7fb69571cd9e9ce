"""Times of the registered queries; prints one JSON line.

Every query runs once to warm up and then ``BENCH_RUNS`` times, its result
going to a sink that discards it; the best time counts. One that has taken
ENOUGH seconds isn't run again. What does the same work as another is left out.
"""

from __future__ import annotations

import json
import os
import sys
import time

from bronzeway.plans.queries import QUERIES
from bronzeway.session import make_session


ENOUGH = 40
SAME_WORK = {"layers_reconciled": "gold_incremental"}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = make_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or (q for q in QUERIES if q not in SAME_WORK):
        taken = []
        while len(taken) <= runs and sum(taken) < ENOUGH:
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(min(taken[1:] or taken), 3)
        print(name, [round(t, 3) for t in taken], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "registered queries, best warm time, summed",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
