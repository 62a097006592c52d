"""Headline queries, timed at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line.

A query runs to the end into the no-op sink, so every row and column is computed. Before
timing, two queries run once on the smallest tables to warm the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("PYTHONWARNINGS", "ignore")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

WARM_UP = "/root/testdata/sf0.001"

HEADLINE = [
    "normalize_quotes",
    "normalize_depth",
    "route_quotes",
    "sequence_diagnostics",
    "lossy_symbols",
    "footprint",
    "asof_depth",
    "replay_interleave",
    "assign_event_id",
    "depth_levels",
    "stale_feeds",
    "stale_attempts",
    "outages",
    "run_status",
    "replay_quarantine",
    "run_manifest",
    "redact_text",
    "symbol_universe",
    "sink_roundtrip",
    "archive_date",
    "stream_sequence",
]


def main() -> None:
    from feedloom.plans.registry import queries
    from feedloom.session import local_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    wanted = queries()
    # Class loading and the first compilations are the JVM's, not the queries'.
    for name in ("normalize_quotes", "sequence_diagnostics"):
        wanted[name](spark, WARM_UP).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        begun = time.perf_counter()
        wanted[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begun, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
