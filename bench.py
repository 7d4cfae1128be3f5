"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Arguments, if
any, name the queries to run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.queries import QUERIES
from tidemark.session import local_session

HEADLINE = [
    "churn_rate_by_period", "churn_target", "panel_columns_on_fact", "entity_history",
    "period_pick", "dedup_rows", "calendar_join", "geo_normalize", "homologate", "melt_wide",
    "code_resolve", "code_metrics", "latest_totals", "tercile_bands", "gold_period_fact",
    "gold_semester_fact", "suppress_flat", "suppress_nested", "demographics_tidy",
    "region_context", "risk_by_group", "kpi_list", "null_profile", "histogram", "density_grid",
    "box_summary", "corr_matrix", "top_categories", "report_region", "pr_curve", "threshold",
    "eval_metrics", "group_folds", "exact_holdout", "fairness_report", "csv_roundtrip",
    "json_roundtrip", "export_clean", "report_read", "incremental_files", "boosted_holdout",
]


def timed(spark, sf: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main(names: list[str]) -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", cores=os.environ.get("BENCH_CPUS", "8"))
    timed(spark, sf, "class_balance")  # starts the JVM side, not counted
    seconds = {name: timed(spark, sf, name) for name in names}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf)}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
