"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected). One warm-up, then the median of
$BENCH_REPEATS runs (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from featurepipe.plans.queries import REGISTRY  # noqa: E402
from featurepipe.session import local_session  # noqa: E402
from featurepipe.sources.tables import SPREAD_CONF  # noqa: E402

HEADLINE = [
    "q02_customer_view_lineitem",
    "q05_transaction_view_lineitem",
    "q08_asof_orders_lineitem",
    "q14_metrics_by_segment_lineitem",
    "q35_feature_psi_lineitem",
    "q04_running_features",
    "q12_stratified_split",
    "q36_score_ks",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="featurepipe-bench")
    spark.conf.set(SPREAD_CONF, cpus)
    per_query: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        try:
            run_once(spark, name, sf_dir)  # warm-up
            per_query[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(repeats)), 3)
        except Exception as ex:  # noqa: BLE001 - report the failure, keep measuring the others
            errors[name] = f"{type(ex).__name__}: {str(ex)[:200]}"
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {
        "metric": "headline_queries_total_median_sec",
        "value": round(sum(per_query.values()), 3),
        "unit": "sec",
        "queries": per_query,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus),
        "config": {"spark.sql.shuffle.partitions": int(cpus) * 2, "aqe": True, "repeats": repeats},
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
