"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_MEM (driver heap, default 4g),
BENCH_QUERIES (comma list, default: the registered headline set).
Each query runs to completion through the ``noop`` sink (full execution,
nothing collected to the driver); a small warm-up query runs first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from murmur.session import get_session
    from murmur.plans import catalog
    spark = get_session(f"local[{cpus}]", app="murmur-bench", shuffle_partitions=max(2 * cpus, 8),
                        extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "4g")})
    qs = catalog.queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or catalog.headline()

    def run(name):
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("json_props")                      # warm-up: JVM, Python workers, file listing
    times = {}
    for name in names:
        t0 = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None}))
    spark.stop()


if __name__ == "__main__":
    main()
