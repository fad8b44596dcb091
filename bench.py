"""Times the headline queries (the median of three runs each) and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from obslake.registry import QUERIES
from obslake.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
#: the median of so many runs of a query counts
RUNS = 3
HEADLINE = [
    "p08_normalise_archive",
    "w01_dedup_observations",
    "w02_w05_indicators",
    "silver_table",
    "a01_daily_aggregates",
    "a01_daily_aggregates_years",
    "a02_weekly_trends",
    "a04_climate_profile",
    "a08_annual_trend",
    "a09_kpi_summary",
    "f10_extreme_events",
    "m01_features_causal",
    "m07_forecast_table",
    "j07_heat_matrix",
    "t09_city_cards",
    "l02_ledger_state",
    "b02_bulletin_text",
]


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["a01_daily_aggregates"].run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name].run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 3)
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
