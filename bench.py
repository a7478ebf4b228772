"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs untimed for at least WARM_UP seconds to load and compile classes, then once timed;
no query leaves anything in the cache. The whole result is computed (noop sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfcast.checks import QUERIES  # noqa: E402
from shelfcast.session import local_session  # noqa: E402

HEADLINE = {
    "daily_aggregate": "daily_sku",
    "lags": "lag_join",
    "moving_averages": "average_join",
    "feature_table": "feature_table",
    "correlation_matrix": "correlation",
    "histogram": "histograms",
    "asof_features": "serving_features",
    "forecast_14_days": "backtest_rows",
    "distinct_counts": "distinct_counts",
    "value_counts": "value_counts_category",
    "summary": "summary",
}


WARM_UP = 15.0


def seconds(spark, name: str, tables: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    tables = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or list(HEADLINE)
    spark = local_session(cpus)
    timed = {}
    for label in only:
        spent = 0.0
        while spent < WARM_UP:
            spent += seconds(spark, HEADLINE[label], tables)
        timed[label] = round(seconds(spark, HEADLINE[label], tables), 3)
        print(label, timed[label], file=sys.stderr, flush=True)
    spark.stop()
    scale = os.path.basename(tables).removeprefix("sf")
    line = {"metric": "total_seconds", "value": round(sum(timed.values()), 3), "unit": "sec", "queries": timed, "sf": scale}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
