"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and fully consumes its result through the ``noop``
sink. Write-type queries include their table writes. After an untimed
warm-up (the flagship, and one write query on the sf0.001 tables), each query is timed ``$BENCH_REPEAT`` times (default
2) and the best time is kept. Prints one JSON line whose ``value`` is the
flagship point-in-time feature query (the job the baseline measures);
``total_sec`` sums every headline query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from daybook.plans.queries import QUERIES  # noqa: E402
from daybook.session import build_session  # noqa: E402

HEADLINE = [
    "pit_features",
    "pit_features_one_day",
    "pit_features_dup_population",
    "pit_features_selected",
    "features_positive_only",
    "pit_join_rows",
    "group_count_sum_avg",
    "dynamic_partition_overwrite",
    "merge_update_insert",
    "daily_publish_merge",
    "compute_replace",
    # checks of the flagship in other plan forms, not recommended ones
    "pit_features_range_join",
    "pit_features_direct",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="daybook-bench", shuffle_partitions=cpus * 2)
    # Untimed warm-up: the flagship on the bench data, and one write path
    # (table create + merge) on the small tables so writer code is JIT-warm.
    consume(QUERIES["pit_features"](spark, sf_dir))
    consume(QUERIES["merge_update_insert"](spark, os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")))
    times, errors = {}, {}
    for name in names:
        best = None
        try:
            for _ in range(repeat):
                t0 = time.perf_counter()
                consume(QUERIES[name](spark, sf_dir))
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
        except Exception as e:  # keep timing the rest; report the failure
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        times[name] = None if best is None else round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    done = [t for t in times.values() if t is not None]
    print(json.dumps({
        "metric": "pit_features_best_sec",
        "value": times.get("pit_features"),
        "total_sec": round(sum(done), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
