"""Bench: run every registered query on $BENCH_SF_DIR and print one JSON line.

Each query runs to completion through the ``noop`` sink (the whole plan is
executed, nothing is collected to the driver). One warm-up query runs first
so JVM start-up and first-query code generation are not charged to a query.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default all), BENCH_RUNS (default 1; best of N).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))

    from tablewright.session import local_session
    from tablewright.workloads.queries import QUERIES

    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2 if cpus.isdigit() else 8), app="tablewright-bench")
    names = os.environ.get("BENCH_QUERIES")
    names = [n for n in names.split(",") if n] if names else list(QUERIES)

    # warm-up (JVM, codegen of common operators)
    try:
        QUERIES["duplicate_keys_lineitem"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    except Exception as e:  # a failed warm-up must not lose the bench line
        print(f"warm-up failed: {e}", file=sys.stderr, flush=True)

    times: dict[str, float | None] = {}
    failed: dict[str, str] = {}
    for n in names:
        best = None
        try:
            for _ in range(runs):
                t0 = time.perf_counter()
                QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
            times[n] = round(best, 3)
        except Exception as e:
            times[n] = None
            failed[n] = str(e).splitlines()[0][:300] if str(e) else type(e).__name__
        print(f"{n}: {times[n]}s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(v for v in times.values() if v is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
