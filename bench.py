"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR.

Prints one JSON line. Every query is executed in full (all rows and columns are
produced and thrown away). The derivation of the panel tables is timed on its own.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillweave.catalog.queries import QUERIES  # noqa: E402
from tillweave.catalog.tables import tables  # noqa: E402
from tillweave.session import clear_scratch, local_session  # noqa: E402

HEADLINE = [
    "quality_report", "merge_sources", "clean_panel", "lags", "rolling_mean", "rolling_std", "rolling_median",
    "rolling_slope", "monthly_index", "dept_encoding", "build_features", "baseline_forecast", "metrics_by",
    "rolling_metrics", "model_ranks", "store_risk", "markdown_roi", "store_dept_mapping", "dashboard_summary",
    "additive_predict", "additive_predict_all", "additive_backtest", "boosted_predict", "boosted_backtest",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    names = sys.argv[1:] or HEADLINE
    times = {}

    def report(*_) -> None:
        print(json.dumps({"metric": "total wall-clock of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
                          "queries": times, "sf": os.path.basename(root.rstrip("/")).removeprefix("sf")}), flush=True)

    def ended(*_) -> None:  # what is done counts, if the run is ended from outside
        report()
        os._exit(1)

    signal.signal(signal.SIGTERM, ended)
    start = time.time()
    derived = tables(spark, root)
    for table in ("sales", "features", "stores"):
        getattr(derived, table)
    times["derive_tables"] = round(time.time() - start, 3)
    for name in names:
        start = time.time()
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    report()
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
