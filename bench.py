"""Time the registered queries and print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores; query names may be given as
arguments.  Every query is run to the end into a sink that discards its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tickstone.plans import REGISTRY
from tickstone.session import build_session

HEADLINE = [
    "daily_ohlcv", "moving_averages", "macd_ema", "market_summary", "report_alerts", "parse_json", "asof_price",
    "mentions", "committed_only", "recent_baseline", "order_rollup", "order_lines", "window_stats", "anomalies",
    "distinct_exact", "top_per_window", "ewma", "market_events", "price_alerts", "dedup_alerts", "sentiment",
    "stream_tumbling", "stream_anomalies", "stream_market_events", "rsi", "crossovers", "suspicious_users", "thresholds",
    "sentiment_in_context", "mentions_indexed",
]


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        started = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    timings = {}
    for name in names:
        once(name)  # warm-up
        timings[name] = round(min(once(name) for _ in range(repeats)), 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
