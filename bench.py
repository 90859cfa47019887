"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the
timed runs of which the median counts. Each run starts from the given tables
and produces every row and column of the result.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from rateflow.session import build_session
from workload.queries import REGISTRY

HEADLINE_QUERIES = [
    "named_volatility_summary",
    "clean_keep_last",
    "fact_market_rates",
    "mart_fx_analytics",
    "mart_yield_curve",
    "rolling_many_series",
    "rolling_chunked",
    "changes_many_series",
    "report_inversions",
    "report_vol_outliers",
    "report_correlations",
    "rates_ffill",
    "headline",
    "ingest_json_observations",
    "ingest_wide_unpivot",
    "ingest_zip_archive",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    event_log = os.environ.get("BENCH_EVENT_LOG")
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    if event_log:
        conf |= {
            "spark.eventLog.enabled": "true",
            "spark.eventLog.compress": "false",
            "spark.eventLog.dir": f"file://{event_log}",
        }
    spark = build_session("bench", master=f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in HEADLINE_QUERIES:
        times = []
        for run in range(runs + 1):
            spark.sparkContext.setJobGroup(name, f"run {run}")
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)  # the first run warms up
    spark.stop()
    print(json.dumps({
        "metric": "total_wall_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
