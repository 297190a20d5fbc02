"""Benchmark: full warehouse build, then every business question on both models.

Mirrors the reference's method: the ETL is timed on its own; each question
is timed warm (1 warm-up, median of BENCH_RUNS runs) against the published
warehouse. Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_ONLY (comma list of question-name substrings).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fathom.plans import questions as Q  # noqa: E402
from fathom.plans.publish import PublishedWarehouse, build_full  # noqa: E402
from fathom.session import build_session, shared_scratch  # noqa: E402


def run(df_fn) -> float:
    t0 = time.perf_counter()
    df = df_fn()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [s for s in os.environ.get("BENCH_ONLY", "").split(",") if s]
    spark = build_session(cpus=cpus, app="fathom-bench")
    scratch = os.environ.get("BENCH_SCRATCH") or shared_scratch(spark, "bench")

    times = {}
    t0 = time.perf_counter()
    info = build_full(spark, sf_dir, scratch)
    times["etl_full"] = round(time.perf_counter() - t0, 3)

    wh = PublishedWarehouse.open(spark, scratch)
    for i, (name, fns) in enumerate(Q.QUESTIONS.items(), start=1):
        if only and not any(s in name for s in only):
            continue
        for model, fn in zip(("store", "star"), fns):
            key = f"q{i:02d}_{name}_{model}"
            run(lambda: fn(wh))  # warm-up
            samples = [run(lambda: fn(wh)) for _ in range(runs)]
            times[key] = round(statistics.median(samples), 3)

    star = sum(v for k, v in times.items() if k.endswith("_star"))
    store = sum(v for k, v in times.items() if k.endswith("_store"))
    out = {
        "metric": "questions_total_sec",
        "value": round(star + store, 3),
        "unit": "sec",
        "queries": times,
        "star_total_sec": round(star, 3),
        "store_total_sec": round(store, 3),
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "runs": runs,
        "max_order_id": info["max_order_id"],
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
