"""Benchmark: resolve the headline workloads at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of query medians, seconds), "unit", "queries", "sf", ...}.
Each query is run once to warm up, then $BENCH_RUNS times (default 3); the median is reported.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from reunion.plans.queries import DOCUMENTS, PARTS, PLANTED  # noqa: E402
from reunion.session import local_session  # noqa: E402


def _sf_of(path: str) -> float | None:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")), app="reunion-bench")

    def resolved_summary(w, threshold=None):
        def run():
            out = w.resolved(spark, sf_dir, threshold)
            row = out.agg(
                F.count(F.lit(1)).alias("rows"),
                F.countDistinct("cluster_id").alias("entities"),
                F.sum("match_probability").alias("psum"),
            ).collect()[0]
            return {"rows": row["rows"], "entities": row["entities"]}

        return run

    workloads = {
        "resolve_planted": resolved_summary(PLANTED),
        "resolve_documents": resolved_summary(DOCUMENTS),
        "resolve_parts": resolved_summary(PARTS),
    }
    sf = _sf_of(sf_dir)

    times: dict[str, float] = {}
    info: dict[str, dict] = {}
    for name, fn in workloads.items():
        info[name] = fn()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    print(
        json.dumps(
            {
                "metric": "resolve_wall_time_sum",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "cpus": cpus,
                "runs": runs,
                "results": info,
            }
        )
    )


if __name__ == "__main__":
    main()
