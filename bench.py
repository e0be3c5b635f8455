"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion through Spark's ``noop`` sink (the whole
plan runs, nothing is collected to the driver); the time is the median of
warm runs. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vigiframe.plans.catalog import QUERIES  # noqa: E402
from vigiframe.session import build_session  # noqa: E402

HEADLINE = ["pipe_weights", "pipe_population", "pipe_establishments", "pipe_census", "pipe_estimate",
            "dt_weekly_counts", "jn_apply_weights", "man_fingerprint", "jn_grid_missing", "pipe_municipalities",
            "fn_sha256", "inc_retain_latest"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def shuffles(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    keys = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    times, exchanges, errors = {}, {}, {}
    for k in keys:
        try:
            warm = QUERIES[k](spark, sf_dir)
            exchanges[k] = shuffles(warm)
            run(warm)                           # warm-up: JIT, file listing, broadcast checks
            samples = []
            for _ in range(repeats):
                t0 = time.perf_counter()
                run(QUERIES[k](spark, sf_dir))
                samples.append(time.perf_counter() - t0)
            times[k] = round(statistics.median(samples), 3)
        except Exception as e:  # noqa: BLE001 - report and keep the one-line contract
            errors[k] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus), "repeats": repeats,
                      "shuffles": exchanges, **({"errors": errors} if errors else {})}))
    spark.stop()


if __name__ == "__main__":
    main()
