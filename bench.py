"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

A query is built and written to the ``noop`` sink. Quick ones are run again warm, and the median
counts; ``cold`` holds the first run of each.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import catalog  # noqa: E402
from gridloom.session import build_session  # noqa: E402

HEADLINE = [
    "values_allowed",
    "values_method_log",
    "normalize_text",
    "parse_dates",
    "main_sheet",
    "dense_grid",
    "fill_down",
    "fill_down_large",
    "number_rows_large",
    "clean_table",
    "headers_rules",
    "enrich",
    "register_submissions",
    "atomic_accept",
    "kpi_report",
    "append_facts",
    "flagship",
]
QUICK = 6.0
REPEATS = 3


def run_once(spark, sf: str, name: str) -> float:
    began = time.perf_counter()
    catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    cold, warm = {}, {}
    for name in names:
        cold[name] = run_once(spark, sf, name)
        repeats = REPEATS if cold[name] < QUICK else 1
        warm[name] = statistics.median(run_once(spark, sf, name) for _ in range(repeats))
    spark.stop()
    result = {
        "metric": "headline_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": {n: round(t, 3) for n, t in warm.items()},
        "cold": {n: round(t, 3) for n, t in cold.items()},
        "sf": Path(sf).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
