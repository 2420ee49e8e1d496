"""Wall time of the headline queries: prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 2)

Every query writes its full result to the no-op sink; the best of the runs is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from zonecast.plans.catalog import CATALOG  # noqa: E402
from zonecast.session import local_session  # noqa: E402

HEADLINE = (
    "hourly_rollup",
    "daily_zone_stats",
    "dq_results",
    "day_validation",
    "parsed_records",
    "nested_points_flatten",
    "missing_worklist",
    "seasonal_lags",
    "feature_table",
    "feature_leak_check",
    "naive_forecasts",
    "conformal_margins",
    "calibrated_intervals",
    "forecast_metrics",
    "track_record_summary",
    "ev_cheapest_plan",
    "ev_strategy_value",
    "battery_arbitrage",
    "price_bins",
    "incremental_merge",
    "stream_hourly",
    "quantile_forest_backtest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    # Start the JVM's code paths once before anything is timed.
    CATALOG["hourly_rollup"][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(1 if name == "quantile_forest_backtest" else runs):
            start = time.perf_counter()
            CATALOG[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
