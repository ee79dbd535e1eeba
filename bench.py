"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full into the ``noop`` sink (every row computed,
nothing collected) after one warm-up pass; the best of ``BENCH_REPEAT`` runs
is reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ferrule.plans.registry import all_queries  # noqa: E402
from ferrule.session import get_session  # noqa: E402

HEADLINE = [
    "client_load_alpha", "client_load_beta", "client_load_gamma", "client_load_revenue_daily",
    "partner_load", "quarantine_split_bad", "event_status", "readiness_gate", "fire_once", "trigger_payload",
    "refresh_by_load", "refresh_window", "batch_ledger_fold", "kpi_client", "revenue_daily_client",
    "revenue_monthly_client", "breakdown_topn", "details_client", "details_partner", "stream_fire_once",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                        extra_conf={"spark.driver.memory": "16g"})
    qs = all_queries()
    run(qs["kpi_client"].build(spark, sf_dir))          # warm-up: JIT, file listing cache
    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(qs[name].build(spark, sf_dir))
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "shuffle_partitions": cpus * 2,
                      "repeat": repeat}))


if __name__ == "__main__":
    main()
