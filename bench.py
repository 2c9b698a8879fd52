"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names; ``all`` runs every query
Each query runs once to warm up and once for the record; results go to a sink that reads every
row and column but stores nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "spend_by_entity_quota", "spend_vs_state_segment_avg", "expense_fact_derived",
    "latest_wins_dedup", "upsert_merge", "upsert_periods", "scd2_history", "asof_version_join",
    "state_switching", "vote_tally", "vote_adherence", "presence_loyalty", "discipline_cohesion",
    "bill_fact", "productivity", "efficiency_scorecard", "activity_full_outer", "spend_ranking",
    "kpi_list", "entity_selector", "entity_kpis", "monthly_evolution", "top15_suppliers",
    "regional_gap", "pareto_top10pct", "lorenz_curve", "month_year_pivot", "consecutive_growth",
    "supplier_concentration", "yearly_outliers", "hhi", "market_share_volatility",
    "expense_type_diversity", "dq_summary",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from ledgerlens.registry import QUERIES

    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    times: dict[str, float] = {}
    for name in names:
        for _ in range(2):
            begin = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - begin, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_warm_query_seconds",
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
