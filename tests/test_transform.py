from pyspark.sql import functions as F

from tollgate.operators import transform as T
from tollgate.plans import expectations as EX
from tollgate.plans import suite as S

from .conftest import collect_set


def test_promote_suppliers_normalise_reject_fill(spark, bronze_suppliers, silver):
    sup = silver["suppliers"]
    promoted = {r["supplier_id"]: r for r in sup.promoted.collect()}
    rejected = collect_set(sup.quarantine, "supplier_id", "reject_reason")
    assert rejected == {("S99", "invalid_status"), ("S05", "missing_name")}
    assert promoted["S02"]["supplier_name"] == "Beta Parts"
    assert promoted["S03"]["contract_start_date"] == "2022-07-14"
    assert promoted["S04"]["email"] == "unknown+s04@example.com"
    assert sup.promoted.count() + sup.quarantine.count() == bronze_suppliers.count()


def test_promote_parts_and_work_orders_cascade(spark, silver):
    assert collect_set(silver["parts"].quarantine, "part_id", "reject_reason") == {
        ("P20", "non_positive_price"), ("P21", "missing_supplier"), ("P23", "orphan_supplier")}
    parts = {r["part_id"]: r for r in silver["parts"].promoted.collect()}
    assert parts["P22"]["part_name"] == "PN-22"  # blank name filled
    assert collect_set(silver["work_orders"].quarantine, "work_order_id") == {"W09", "W10"}
    wo = {r["work_order_id"]: r for r in silver["work_orders"].promoted.collect()}
    assert wo["W11"]["actual_delivery"] == wo["W11"]["expected_delivery"]


def test_corrections_table_fills_from_outside(spark, bronze_parts, silver):
    corr = spark.createDataFrame([("P21", "S01")], "part_id string, supplier_id string")
    p = T.promote_parts(bronze_parts, silver["suppliers"].promoted, "2024-05-01", corrections=corr)
    assert "P21" in collect_set(p.promoted, "part_id")


def test_silver_parts_gate_passes_after_promotion(spark, silver):
    checks = [c for c in EX.SUITES["silver_parts"] if c.kind != "row_count"]
    res = S.run_suite(silver["parts"].promoted, checks, "parts", "silver")
    failing = [r["rule"] + ":" + str(r["column_name"]) for r in res.collect() if not r["passed"]]
    assert failing == ["expect_column_values_to_be_between:lead_time_days"]  # P24's 400 days survives promotion


def test_build_gold_kpis(spark, silver):
    gold = T.build_gold(silver["work_orders"].promoted, silver["parts"].promoted, silver["suppliers"].promoted, "2024-05-01")
    g = {(r["metric_month"], r["supplier_id"]): r for r in gold.collect()}
    jan_s01 = g[("2024-01", "S01")]
    assert (jan_s01["total_orders"], jan_s01["total_spend"], jan_s01["on_time_delivery_pct"]) == (1, 120.0, 100.0)
    feb_s03 = g[("2024-02", "S03")]  # only an OPEN order → zero KPIs
    assert (feb_s03["total_orders"], feb_s03["total_spend"]) == (0, 0.0)
    mar_s06 = g[("2024-03", "S06")]
    assert mar_s06["defect_rate_pct"] == 3.0 and mar_s06["avg_lead_time_days"] == 10.0


def test_silver_aggregate_only_closed_and_partial(spark, silver):
    agg = T.silver_aggregate(silver["work_orders"].promoted, silver["parts"].promoted)
    keys = collect_set(agg, "metric_month", "supplier_id")
    assert ("2024-02", "S03") not in keys and ("2024-02", "S01") in keys
    assert agg.filter(F.col("silver_order_count") < 1).count() == 0


def _copies(spark, n):
    """Rows of which every third has key K7 and every other key is unique; some rows are equal."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("K7")).otherwise(F.concat(F.lit("U"), F.col("id").cast("string"))).alias("k"),
        (F.col("id") % 40 + 1).cast("double").alias("x"), F.lit("P").alias("fk"))


def test_first_row_of_a_hot_repeated_key(spark):
    df = _copies(spark, 6000)
    spec = T.PromoteSpec(key="k", reject=[("small", F.col("x") < 4)])
    p = T.promote(df, spec)
    promoted, rejected = p.promoted.collect(), p.quarantine.collect()
    assert len(promoted) + len(rejected) == 6000
    hot = [r for r in promoted if r.k == "K7"]
    assert len(hot) == 1 and hot[0].x == 4.0  # the least that is left
    assert sum(r.reject_reason == "duplicate_key" for r in rejected) == sum(1 for i in range(0, 6000, 3) if i % 40 + 1 >= 4) - 1
    assert {r.k for r in promoted} == {"K7"} | {f"U{i}" for i in range(6000) if i % 3 and i % 40 + 1 >= 4}
    plan = p.promoted._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_promotion_reads_its_input_once(spark, tmp_path):
    path = f"/tmp/tollgate-promote-{tmp_path.name}-{F.__name__}"
    _copies(spark, 3000).write.mode("overwrite").parquet(path)
    parent = spark.createDataFrame([("P",)], "pk string")
    read = []
    parquet = spark.read.parquet(path)
    spec = T.PromoteSpec(key="k", parents=[("fk", parent, "pk", "orphan")])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        write = type(parquet.write).parquet

        def spy(self, *a, **k):
            read.append(self._df._jdf.queryExecution().optimizedPlan().toString().count("parquet"))
            return write(self, *a, **k)

        import pytest

        with pytest.MonkeyPatch.context() as m:
            m.setattr(type(parquet.write), "parquet", spy)
            p = T.promote(parquet, spec)
        assert read[0] == 1  # the child; everything after reads what was written
        assert p.promoted.count() == 2001 and p.quarantine.count() == 999
        assert path not in "".join(p.flagged.inputFiles())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_rows_of_repeated_keys_are_joined(spark, monkeypatch):
    seen = []
    split = T.split_by
    monkeypatch.setattr(T, "split_by", lambda *a: seen.append(split(*a)) or seen[-1])
    rows = [(f"K{i % 900}", float(i)) for i in range(1000)] + [(None, 1.0)]
    p = T.promote(spark.createDataFrame(rows, "k string, x double"), T.PromoteSpec(key="k"))
    assert p.promoted.count() == 901 and {r.k for r in p.quarantine.collect()} == {f"K{i}" for i in range(100)}
    assert all(r.x >= 900 for r in p.quarantine.collect())
    assert 200 <= seen[0][0].count() < 250 and seen[0][0].count() + seen[0][1].count() == 1001


def test_gold_totals_are_worked_out_before_the_join(spark):
    orders = spark.createDataFrame(
        [("W1", "P1", "2024-01-05", "CLOSED", 5, 4, 10.0, 1, "2024-02-01", "2024-02-02"), ("W1", "P1", "2024-01-06", "PARTIAL", 5, 4, 10.0, 1, "2024-02-03", "2024-02-02"),
         ("W2", "P1", "2024-01-07", None, 7, 7, 7.0, 7, None, None), (None, "P1", "2024-01-07", "CLOSED", 1, 0, None, 0, None, "2024-02-02"),
         ("W3", None, "2024-01-07", "CLOSED", 1, 1, 1.0, 1, None, None), ("W4", "P2", "bad", "OPEN", 1, 1, 1.0, 1, None, None)],
        "work_order_id string, part_id string, order_date string, status string, quantity_ordered bigint, quantity_received bigint, total_cost double, "
        "defect_count bigint, actual_delivery string, expected_delivery string")
    parts = spark.createDataFrame([("P1", "S1", 10), ("P2", "S1", 20)], "part_id string, supplier_id string, lead_time_days bigint")
    suppliers = spark.createDataFrame([("S1", "one", 4.5)], "supplier_id string, supplier_name string, quality_rating double")
    gold = T.build_gold(orders, parts, suppliers)
    got = {r.metric_month: r for r in gold.collect()}
    jan = got["2024-01"]
    assert (jan.total_orders, jan.total_parts_ordered, jan.total_parts_received, jan.total_spend, jan.defect_count) == (1, 11, 8, 20.0, 2)
    assert (jan.on_time_delivery_count, jan.on_time_delivery_pct, jan.avg_lead_time_days) == (1, 33.33, 10.0)
    assert (got[None].total_orders, got[None].total_spend, got[None].avg_lead_time_days) == (0, 0.0, 0.0)

    def joins(node):
        found = [node] if node.nodeName() == "Join" else []
        return found + [x for i in range(node.children().size()) for x in joins(node.children().apply(i))]

    sides = "".join(j.children().apply(0).output().toString() for j in joins(gold._jdf.queryExecution().optimizedPlan()))
    assert "part_id" in sides and not any(c in sides for c in ("order_date", "status", "expected_delivery"))
