"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``: one warm-up pass over all queries, then the median of
``$BENCH_REPEAT`` (default 3) timed runs each.  A run executes the full plan
into the ``noop`` sink (nothing is collected).  The streaming pipeline
(bronze -> silver -> gold, ``availableNow``) is timed once.  Prints one JSON
line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "fraud_score", "alerts", "card_stats", "silver_dedup", "fraud_by_type", "top_risk_cards",
    "zscore_distribution", "fraud_by_country", "layer_summary", "velocity_rolling", "impossible_travel",
    "burst_sessions", "amount_spike", "fraud_score_event_time", "card_profile", "prev_txn",
    "merchant_enrich", "events_per_minute", "cumulative_events",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from cardwatch.plans.catalog import REGISTRY
    from cardwatch.session import build_session

    spark = build_session(
        "cardwatch-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus),
        extra={"spark.driver.memory": "8g",
               "spark.checkpoint.dir": tempfile.mkdtemp(prefix="cw-bench-")},
    )

    def run(name: str) -> float:
        t0 = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in HEADLINE:
        run(name)
    times = {name: round(statistics.median(run(name) for _ in range(repeat)), 3) for name in HEADLINE}

    n_events = spark.read.parquet(os.path.join(sf_dir, "events.parquet")).count()
    t0 = time.perf_counter()
    REGISTRY["gold_stream"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    stream_s = time.perf_counter() - t0
    times["stream_pipeline"] = round(stream_s, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(v for k, v in times.items() if k != "stream_pipeline"), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": int(cpus),
        "events": n_events,
        "stream_rows_per_sec": round(n_events / stream_s, 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
