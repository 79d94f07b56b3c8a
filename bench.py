"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores.
A query's time covers planning, its eager steps and the full result, written to no sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelwise.plans.catalog import QUERIES  # noqa: E402
from panelwise.session import local_session  # noqa: E402

HEADLINE = (
    "flagship_features agg_monthly agg_annual_sum agg_annual_per_entity agg_count_distinct "
    "join_full_outer join_left_composite join_trends pivot_first pivot_multi_value lag_multi rolling_mean "
    "rolling_std pct_change_ffill anomaly_trailing anomaly_global latest_ranking top_k numeric_summary "
    "median_impute corr_prune quadratic_trend regression_metrics forecast_trend seasonal_disaggregate "
    "ensemble_weighted scenario_score coerce_numeric csv_bad_lines json_map_series model_ridge "
    "model_random_forest batch_score"
).split()


def run(spark, name: str, sf: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 1)
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "flagship_features", sf)  # start-up and first compilation are not the query's
    times = {name: round(run(spark, name, sf), 3) for name in HEADLINE}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf.rstrip("/")),
        "cpus": cpus,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
