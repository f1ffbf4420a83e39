"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores) and
BENCH_RUNS (default 2, after one warm-up) set the scale.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from lectern.registry import QUERIES
from lectern.session import session

HEADLINE = [
    "class_ranking", "rank_ntile4", "student_360", "topk_student_360", "course_panel", "course_panel_exact",
    "weighted_gpa", "weighted_grade", "balance_summary", "payments_rollup", "distinct_counts", "event_health",
    "telemetry_daily", "minute_counts", "join_latest_lateral", "join_mode_lateral", "join_nonequi_guard",
    "fact_academic", "fact_finance", "fact_telemetry", "kpi_active_students", "rebuild_warehouse",
    "bulk_enrol", "bulk_post_grade", "bulk_pay", "audit_update_diff", "rule_unique", "rule_cross_table",
    "stream_minute_counts", "stream_payment_rollup",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(
        "lectern-bench", master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(2 * int(cpus)),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in HEADLINE if len(sys.argv) < 2 or n in sys.argv[1:]]
    times = {}
    for name in names:
        samples = []
        for n in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if n:
                samples.append(time.perf_counter() - start)
        times[name] = round(statistics.median(samples), 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "total seconds over headline queries, median of warm runs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
