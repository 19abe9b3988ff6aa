"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wattloom_checks.queries import QUERIES  # noqa: E402
from wattloom.session import build_session  # noqa: E402

HEADLINE = [
    "bronze_calendar_parts",
    "time_bucket_hour",
    "dedupe_then_hourly",
    "weather_json_rows",
    "silver_join",
    "silver_holidays",
    "gold_rolling_7d",
    "gold_lag_7d",
    "gold_fact",
    "gold_fact_since",
    "upsert_silver",
    "upsert_silver_stored",
    "partition_replace",
    "replace_keys",
    "increment_slice_by_region",
    "holiday_calendar",
    "dq_gaps",
    "dq_summary",
]


def timed(run) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # starts the JVM's readers and code generation, so the first query is not charged
    timed(lambda: QUERIES["time_bucket_day"](spark, sf_dir))
    seconds = {name: round(timed(lambda name=name: QUERIES[name](spark, sf_dir)), 3) for name in HEADLINE}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
