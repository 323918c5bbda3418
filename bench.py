"""Time the headline queries and print one JSON line.

Each query runs once to warm up and three times measured; the median counts. Derived
inputs are written before the clock starts and their cost is reported apart.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame

from checks.inputs import flat_table, nested_table, session_table
from checks.queries import queries
from eventloom.session import local_session
from eventloom.sources.scratch import clear_scratch

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
HEADLINE = (
    "flatten_events",
    "flatten_events_adaptive",
    "t1_daily_summary",
    "t2_orders",
    "t2_order_items",
    "t3_session_funnel",
    "t3_session_funnel_history",
    "t4_funnel_daily",
    "t5_device_channel",
    "t6_user_features",
    "t6_user_features_from_partials",
    "ml_user_features",
    "prediction_trend",
)


def run(df: DataFrame) -> None:
    """Execute all of a DataFrame without keeping its rows."""
    df.write.format("noop").mode("overwrite").save()


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS)
    inputs = {"flat": flat_table, "sessions": session_table, "nested": nested_table}
    prepared = {
        name: round(seconds(lambda t=table: t(spark, SF_DIR)), 3)
        for name, table in inputs.items()
    }
    rows = {name: table(spark, SF_DIR).count() for name, table in inputs.items()}
    registered = queries()
    timings = {}
    for name in HEADLINE:
        action = lambda q=registered[name]: run(q(spark, SF_DIR))
        action()
        timings[name] = round(
            statistics.median(seconds(action) for _ in range(REPEATS)), 3
        )
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "input_rows": rows,
                "prepare_sec": prepared,
            }
        )
    )
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
