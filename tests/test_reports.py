"""Gold report ladders on a hand-built gold table, checked row by row."""
from tollgate.operators import reports as RP

from .conftest import collect_set

GOLD_SCHEMA = ("metric_month string, supplier_id string, supplier_name string, total_orders bigint, total_parts_ordered bigint, "
               "total_parts_received bigint, total_spend double, defect_count bigint, defect_rate_pct double, "
               "on_time_delivery_pct double, avg_lead_time_days double, quality_score double")


def test_reconciliation_ladder(spark, silver):
    wo, parts = silver["work_orders"].promoted, silver["parts"].promoted
    # silver: 2024-01/S01 spend 120 (W01), 2024-01/S02 322 defects 1 (W02), 2024-02/S01 600 (W03),
    # 2024-03/S04 990 defects 1, 2024-03/S06 325 defects 3, 2024-03/S02 483 (W11), 2024-03/S03 110 (W12)
    gold = spark.createDataFrame([
        ("2024-01", "S01", "A", 1, 10, 10, 120.0, 0, 0.0, 100.0, 30.0, 4.5),    # PASS
        ("2024-01", "S02", "B", 1, 4, 4, 330.0, 1, 25.0, 0.0, 45.0, 3.9),      # spend +2.5% → FAIL spend
        ("2024-02", "S01", "A", 1, 5, 2, 600.0, 1, 50.0, 100.0, 30.0, 4.5),    # defects 1 vs 0 → FAIL defect
        ("2024-03", "S04", "D", 2, 1, 1, 990.0, 1, 100.0, 100.0, 60.0, 2.8),   # orders 2 vs 1 → FAIL orders
        ("2024-04", "S01", "A", 0, 0, 0, 0.0, 0, 0.0, 0.0, 0.0, 4.5),          # no silver → WARN
    ], GOLD_SCHEMA)
    got = {(r["metric_month"], r["supplier_id"]): (r["reconciliation_status"], r["status_rank"])
           for r in RP.gold_reconciliation(gold, wo, parts).collect()}
    assert got == {
        ("2024-01", "S01"): ("PASS", 5),
        ("2024-01", "S02"): (RP.RECON_SPEND, 1),
        ("2024-02", "S01"): (RP.RECON_DEFECT, 2),
        ("2024-03", "S04"): (RP.RECON_ORDERS, 3),
        ("2024-04", "S01"): (RP.RECON_NO_SILVER, 4),
    }
    sing = collect_set(RP.singular_gold_reconciliation(gold, wo, parts), "metric_month", "supplier_id")
    assert sing == {("2024-01", "S02")}


def test_kpi_alerts_and_continuity(spark):
    gold = spark.createDataFrame([
        ("2024-01", "S1", "A", 1, 10, 12, 100.0, 13, 108.33, 90.0, 5.0, 0.5),
        ("2024-02", "S1", "A", 1, 10, 10, 100.0, 1, 10.0, 80.0, 5.0, 3.2),
        ("2024-05", "S2", "B", 1, 10, 10, -5.0, 3, 30.0, 60.0, 5.0, 4.0),
    ], GOLD_SCHEMA)
    kv = {r["metric_month"]: (r["violations"], r["violation_count"]) for r in RP.kpi_violations(gold).collect()}
    assert kv["2024-01"] == ("defect_rate_pct=108.33 quality_score=0.5 received>ordered defects>received ", 4)
    assert kv["2024-05"] == ("total_spend=-5.0 ", 1)
    alerts = {r["metric_month"]: (r["defect_alert"], r["otd_alert"], r["quality_alert"]) for r in RP.supplier_alerts(gold).collect()}
    assert alerts["2024-02"] == ("OK", "WARNING — OTD <85% (threshold: 85%)", "WARNING — quality score <3.5")
    assert alerts["2024-05"][0] == "CRITICAL — defect rate >30.0% (threshold: 20%)"
    gaps = collect_set(RP.month_continuity(gold), "gap_after", "gap_before", "months_apart")
    assert gaps == {("2024-02", "2024-05", 3)}
    bounds = collect_set(RP.kpi_bounds(gold), "metric_month")
    assert bounds == {"2024-01", "2024-05"}
