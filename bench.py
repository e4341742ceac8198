"""Benchmark: run the catalogue queries and print ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all
cores), BENCH_RUNS (timed runs per query, default 3; the median is
reported), BENCH_ML=1 to include the model-training keys, BENCH_ONLY to
run a comma-separated subset.

Each query is fully executed by writing it to the ``noop`` sink, after
one warm-up run.  The time includes planning and any eager step the query
needs (the stream run, the written ordering table).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

ML_KEYS = {"feature_report", "model_comparison", "importance", "forecast_model",
           "linear_comparison", "linear_importance", "linear_forecast"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from shopcast.session import get_session
    from shopcast.plans.catalog import queries
    spark = get_session(f"local[{cpus}]", app="shopcast-bench",
                        shuffle_partitions=max(8, 2 * cpus))
    qs = queries()
    only = os.environ.get("BENCH_ONLY")
    keys = [k for k in qs if (os.environ.get("BENCH_ML") == "1" or k not in ML_KEYS)]
    if only:
        keys = [k for k in only.split(",") if k in qs]
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for k in keys:
        def once() -> float:
            t0 = time.perf_counter()
            qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        try:
            once()
            times[k] = round(statistics.median(once() for _ in range(runs)), 3)
        except Exception as e:  # keep going; report the failure
            errors[k] = str(e).splitlines()[0][:200]
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
