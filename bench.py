"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced with the ``noop`` sink (full execution, nothing pulled to
the driver): one warm-up, then the median of three runs.  Also measures one
fused 20-check suite against the same checks run one action each, and counts
the table scans in the fused plan.  Prints ONE JSON line.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tollgate.plans import registry  # noqa: E402
from tollgate.plans import suite as S  # noqa: E402
from tollgate.session import local_session  # noqa: E402
from tollgate.sources.layers import materialized  # noqa: E402

HEADLINE = [
    "gold_reconciliation", "build_gold", "promote_silver", "quarantine", "run_suite", "run_gate", "null_rates",
    "pk_unique", "composite_pk_unique", "referential_integrity", "orphans_orders_parts", "iqr_bounds", "zscore_outliers",
    "kpi_violations", "supplier_alerts", "top_spend_variance", "scoped_sum_reconcile", "rules_work_orders", "triage",
    "tolerance_budget",
]


def timed(fn, runs=3):
    fn()  # warm-up
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def force(df):
    df.write.format("noop").mode("overwrite").save()


def orders_checks():
    """20 per-row checks over the bronze work orders (one table)."""
    c = S.Check
    return [
        c("not_null", "work_order_id"), c("not_null", "part_id"), c("not_null", "order_date"), c("not_null", "status"),
        c("not_null", "actual_delivery", mostly=0.5), c("in_set", "status", {"values": ["OPEN", "CLOSED", "PARTIAL", "CANCELLED"]}),
        c("in_set", "source_system", {"values": ["ERP_SAP", "LEGACY_SYSTEM", "MDM_PROFISEE", "MANUAL_ENTRY"]}),
        c("between", "quantity_ordered", {"min": 1, "max": 50}), c("between", "quantity_received", {"min": 0, "max": 50}),
        c("between", "total_cost", {"min": 0.01}), c("between", "unit_cost", {"min": 0.01}),
        c("between", "defect_count", {"min": 0}), c("strftime", "order_date", {"format": "%Y-%m-%d"}),
        c("strftime", "expected_delivery", {"format": "%Y-%m-%d"}), c("strftime", "actual_delivery", {"format": "%Y-%m-%d"}),
        c("match_regex", "work_order_id", {"regex": r"^WO-[0-9]+-[0-9]+$"}), c("match_regex", "part_id", {"regex": r"^PART[0-9]+$"}),
        c("not_empty", "part_id"), c("expression", None, {"expr": "quantity_received <= quantity_ordered"}),
        c("expression", None, {"expr": "NOT (status = 'CLOSED' AND actual_delivery IS NULL)"}),
    ]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="tollgate-bench")
    per_query = {}
    for key in HEADLINE:
        fn = registry.QUERIES[key]
        per_query[key] = timed(lambda fn=fn: force(fn(spark, sf_dir)))

    m = materialized(spark, sf_dir)  # the landed bronze table, as a gate reads it
    wo = m.bronze_work_orders
    checks = orders_checks()
    fused = S.run_suite(wo, checks, "work_orders", "bronze")
    fused_sec = timed(lambda: force(fused))
    unfused_sec = timed(lambda: [force(S.run_suite(wo, [ch], "work_orders", "bronze")) for ch in checks], runs=1)
    plan = fused._jdf.queryExecution().executedPlan().toString()
    scans = plan.count("Scan parquet")  # matches "FileScan parquet" too
    # one-time cost of landing bronze and writing silver + gold (fresh folder, not reused)
    from tollgate.session import shared_path
    from tollgate.sources.layers import Medallion

    t0 = time.perf_counter()
    Medallion(spark, sf_dir).materialize(root=shared_path(spark, "bench", f"layers-{time.time_ns()}"))
    layers_write_sec = round(time.perf_counter() - t0, 3)
    total = round(sum(per_query.values()), 3)
    print(json.dumps({
        "metric": "sum_median_sec_headline_queries", "value": total, "unit": "sec", "queries": per_query,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": cpus,
        "fused_suite_20_checks_sec": fused_sec, "unfused_suite_20_checks_sec": unfused_sec,
        "fused_suite_file_scans": scans, "fused_suite_source_tables": 1, "layers_write_sec": layers_write_sec,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
