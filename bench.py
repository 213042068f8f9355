"""Time every registered query on one scale factor and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default all).  Each query runs to completion through
the ``noop`` sink (full computation, no collect to the driver).  Each query runs
twice: ``cold`` is the first run (includes code generation and Python-worker
start-up), ``queries`` the second, steady-state run; ``value`` sums the latter.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mailframe.plans import QUERIES  # noqa: E402
from mailframe.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or sorted(QUERIES)
    spark = get_session(cpus, app="mailframe-bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    QUERIES["counts_by_index"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, cold, errors = {}, {}, {}
    for n in names:
        try:
            for store in (cold, times):
                t = time.perf_counter()
                QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
                store[n] = round(time.perf_counter() - t, 3)
        except Exception as e:  # keep the one-line report; name the failure
            errors[n] = f"{type(e).__name__}: {str(e)[:200]}"
            times.pop(n, None)
            cold.pop(n, None)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold_total": round(sum(cold.values()), 3),
        "cold": cold,
        **({"errors": errors} if errors else {}),
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
