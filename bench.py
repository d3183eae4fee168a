"""Times the headline queries and prints one JSON line.

Folder and cores come from BENCH_SF_DIR and BENCH_CPUS. Each query runs once to warm up and
then BENCH_RUNS times; the median is reported. Results are fully computed, not collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from serieslake.registry import QUERIES  # noqa: E402
from serieslake.session import build_session  # noqa: E402

HEADLINE = [
    "last_value",
    "last_wins",
    "value_scan",
    "value_topn",
    "pivot_last_wins",
    "pivot_values",
    "melt_values",
    "group_series",
    "filter_options_all",
    "derived_batch",
    "conform_ffill",
    "realized_vol",
    "resample_month_end",
    "ohlc_weekly",
    "corr_matrix",
    "boxplot",
    "quality_values",
    "availability_report",
    "driver_features",
    "ols_moments",
    "ols_rolling",
    "fair_value_fit",
    "fair_value_history",
    "signals",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "serieslake-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in HEADLINE:
        seconds = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - started)
        timings[name] = round(statistics.median(seconds[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
