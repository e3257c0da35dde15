"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Each query
runs to the end into a sink that drops the rows; one small query warms the session up first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marlstone.plans.registry import load_all  # noqa: E402
from marlstone.session import get_session  # noqa: E402

HEADLINE = [
    "hash_split_documents",
    "shared_customers_across_time_split",
    "impute_events",
    "scale_lineitem",
    "onehot_events",
    "target_encode_orders",
    "hash_features_events",
    "rolling_week_events",
    "rolling_month_suppliers",
    "lags_events",
    "sessions_events",
    "asof_click_before_purchase",
    "customer_history_orders",
    "tfidf_documents",
    "profile_lineitem",
    "quantiles_by_flag_lineitem",
    "correlation_lineitem",
    "rank_correlation_lineitem",
    "mutual_information_orders",
    "drift_by_week_events",
    "line_fit_lineitem",
    "naive_bayes_auc",
    "nearest_centroid_embeddings",
    "neighbours_embeddings",
    "best_split_lineitem",
    "class_report_lineitem",
    "auc_by_status_price",
    "roc_lineitem",
    "calibration_lineitem",
    "lift_orders",
    "regression_report_lineitem",
    "stream_daily_windows",
    "stream_sessions",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = load_all()
    chosen = sys.argv[1:] or HEADLINE
    known["time_split_orders"].run(spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in chosen:
        start = time.perf_counter()
        known[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    scale = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall clock",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
