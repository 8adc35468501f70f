import tempfile
from pathlib import Path

import pytest

from tollgate.sources import catalog as CAT
from tollgate.sources import sinks as SK
from tollgate.plans import suite as S


@pytest.fixture(scope="module")
def csv_root():
    root = Path(tempfile.mkdtemp(prefix="tollgate-csv-", dir="/tmp"))
    (root / "bronze").mkdir()
    (root / "gold").mkdir()
    # a short row (one field missing) must be right-padded with null
    (root / "bronze" / "suppliers_raw.csv").write_text(
        "supplier_id,status,quality_rating,load_timestamp\nS1,ACTIVE,4.5,2024-01-15 06:00:00\nS2,INACTIVE,INACTIVE\n")
    (root / "gold" / "production_metrics.csv").write_text("metric_month,supplier_id\n2024-01,S1\n")
    return str(root)


def test_load_table_case_insensitive_all_string(spark, csv_root):
    cat = CAT.Catalog(csv_root, schemas={"bronze.suppliers": CAT.all_string_schema(
        ["supplier_id", "status", "quality_rating", "load_timestamp"])})
    df = CAT.load_table(spark, cat, "BRONZE", "Suppliers")
    rows = {r["supplier_id"]: r for r in df.collect()}
    assert rows["S2"]["quality_rating"] == "INACTIVE" and rows["S2"]["load_timestamp"] is None
    gold = CAT.load_table(spark, cat, "gold", "production_metrics")
    assert dict(gold.dtypes)["metric_month"] == "string"  # no inference → YYYY-MM stays text
    with pytest.raises(ValueError):
        CAT.load_table(spark, cat, "platinum", "x")
    with pytest.raises(ValueError):
        CAT.load_table(spark, cat, "gold", "nope")


def test_load_layer_typed_load_and_discovery(spark, csv_root):
    cat = CAT.Catalog(csv_root)
    assert set(CAT.load_layer(spark, cat, "gold")) == {"production_metrics"}
    df = spark.createDataFrame([("4.5",), ("INACTIVE",)], "quality_rating string")
    assert [r[0] for r in CAT.typed_load(df, {"quality_rating": "double"}).collect()] == [4.5, None]
    assets = {r["asset_name"] for r in CAT.discover_assets(spark, csv_root + "/bronze").collect()}
    assert assets == {"suppliers_raw"}


def test_store_results_appends_by_layer(spark, bronze_suppliers):
    root = tempfile.mkdtemp(prefix="tollgate-store-", dir="/tmp")
    res = S.run_suite(bronze_suppliers, [S.Check("not_null", "email")], "suppliers", "bronze")
    first = SK.store_results(spark, res, "20240101-000000-bronze-gate", root=root + "/r")
    SK.store_results(spark, res, "20240102-000000-bronze-gate", root=root + "/r")
    assert first.count() == 1
    assert spark.read.parquet(root + "/r").filter("layer = 'bronze'").count() == 2
    again = SK.store_results(spark, res, "20240101-000000-bronze-gate", root=root + "/r")  # the name of another run
    assert first.count() == again.count() == 1
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan
    assert S.run_name("bronze").endswith("-bronze-gate")


def test_materialized_layers_stay_readable(spark):
    from pyspark.sql import functions as F

    root = tempfile.mkdtemp(prefix="tollgate-layer-", dir="/tmp")
    one = SK.materialize_layer(spark, spark.range(3), "silver", "t", root=root)
    two = SK.materialize_layer(spark, spark.range(5), "silver", "t", root=root)
    assert one.count() == 3 and two.agg(F.count("*")).first()[0] == 5 and spark.table("silver_t").count() == 5


def test_fingerprint_sees_files_at_any_depth(spark):
    from tollgate.sources.layers import Medallion

    root = tempfile.mkdtemp(prefix="tollgate-print-", dir="/tmp")
    spark.range(3).write.parquet(root + "/lineitem.parquet")
    before = Medallion(spark, root).fingerprint()
    assert Medallion(spark, root).fingerprint() == before
    spark.range(1).write.mode("append").parquet(root + "/lineitem.parquet")
    assert Medallion(spark, root).fingerprint() != before


def test_json_totals_sink(spark):
    from tollgate.operators import triage as TR

    runs = spark.createDataFrame([(1, "tests/sql/t.py::a", "", "passed", ""), (2, "tests/gold/t.py::b", "", "failed", "E   AssertionError: x")],
                                 "run_id int, node_id string, keywords string, outcome string, longrepr string")
    path = tempfile.mkdtemp(prefix="tollgate-json-", dir="/tmp") + "/totals"
    SK.write_json_totals(TR.result_totals(TR.triage(runs)), path)
    got = {r["decision"]: r["n_runs"] for r in spark.read.json(path).collect()}
    assert got == {"pass": 1, "must_fail": 1}


def test_report_of_runs_as_json(spark):
    from tollgate.operators import triage as TR

    runs = spark.createDataFrame([(1, "tests/sql/t.py::a", "", "passed", ""), (2, "tests/gold/t.py::b", "", "failed", "E   AssertionError: x")],
                                 "run_id int, node_id string, keywords string, outcome string, longrepr string").repartition(2)
    root = tempfile.mkdtemp(prefix="tollgate-json-", dir="/tmp")
    triaged = TR.triage(runs)
    totals = SK.write_json(TR.report_totals(triaged), root + "/totals")
    got = {(r["layer"], r["decision"]): r["n_runs"] for r in totals.collect()}
    assert got == {("sql", "pass"): 1, ("gold", "must_fail"): 1, ("sql", None): 1, ("gold", None): 1, (None, None): 2}
    records = {r["run_id"]: r for r in SK.write_json(TR.run_records(triaged), root + "/tests").collect()}
    assert records[2]["classification"]["error"]["class"] == "AssertionError" and records[1]["test"]["outcome"] == "passed"
    assert len(list(Path(root, "tests").glob("part-*"))) == 2  # not drawn into one task
    assert TR.report_totals(triaged.where("false")).collect() == []


def test_csv_by_schema_keeps_short_and_ill_typed_rows(spark):
    root = Path(tempfile.mkdtemp(prefix="tollgate-short-", dir="/tmp"))
    (root / "t.csv").write_text('k,phone,n,x\na,007,5,1.5\nb,8\nc,9,five,2.5\n"d, e",,6,3.5,extra\n')
    types = {"k": "string", "phone": "bigint", "n": "bigint", "x": "double"}
    cat = CAT.Catalog(str(root), {"raw": {"t": "t.csv"}}, {"raw.t": CAT.csv_schema(types)}, layer_dirs=False)
    rows = {r.k: r for r in CAT.load_table(spark, cat, "raw", "t").collect()}
    assert (rows["a"].phone, rows["a"].n, rows["a"].x, rows["a"][CAT.CORRUPT]) == ("007", 5, 1.5, None)
    assert (rows["b"].phone, rows["b"].n, rows["b"].x, rows["b"][CAT.CORRUPT]) == ("8", None, None, "b,8")
    assert rows["c"].n is None and rows["c"][CAT.CORRUPT].startswith("c,9") and rows["d, e"][CAT.CORRUPT].endswith("extra")
    assert dict(CAT.load_table(spark, cat, "raw", "t").dtypes)["n"] == "bigint"
    marked = CAT.load_table(spark, cat, "raw", "t").select("k", CAT.CORRUPT).where(f"{CAT.CORRUPT} IS NOT NULL")
    assert sorted(r.k for r in marked.collect()) == ["b", "d, e"]  # rows of another length, whichever columns are read


def test_layer_tables_carry_their_tags(spark):
    SK.materialize_layer(spark, spark.range(4), "gold", "kpis")
    name = f"{SK.layer_schema(spark, 'gold')}.kpis"
    properties = SK.table_properties(spark, name)
    assert spark.table(name).count() == 4 and (properties["layer"], properties["tags"]) == ("gold", "gold,curated")
    SK.materialize_layer(spark, spark.range(6), "gold", "kpis", partition_by=())
    assert spark.table(name).count() == 6


def test_seed_types_keep_text_columns(spark):
    df = spark.createDataFrame([(1, 20240115, "x")], "phone int, contract_start_date int, other string")
    types = CAT.seed_types(df.columns)
    assert types == {"contract_start_date": "string", "phone": "string"}
    assert dict(CAT.typed_load(df, types).dtypes) == {"phone": "string", "contract_start_date": "string", "other": "string"}


def test_a_layer_is_written_when_it_is_asked_for(spark):
    from tollgate.sources.layers import Medallion

    sf = tempfile.mkdtemp(prefix="tollgate-sf-", dir="/tmp")
    root = tempfile.mkdtemp(prefix="tollgate-ondemand-", dir="/tmp")
    spark.createDataFrame([(1, "a", 0, 5.0), (2, "b", 0, 6.0), (3, "c", 9, 7.0)], "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double") \
        .write.parquet(sf + "/supplier.parquet")
    spark.createDataFrame([(0, "X")], "n_nationkey int, n_name string").write.parquet(sf + "/nation.parquet")
    m = Medallion(spark, sf).on_demand(root)  # no work orders, parts or events: nothing may ask for them
    assert m.bronze_suppliers.count() == 3
    assert {p.name for p in Path(root).iterdir()} == {"bronze_suppliers"}
    silver, quarantine = m.silver_suppliers.count(), m._suppliers.quarantine.count()
    assert silver + quarantine == 3 and {p.name for p in Path(root).iterdir()} == {"bronze_suppliers", "suppliers_flagged"}
    again = Medallion(spark, sf).on_demand(root)
    assert again.bronze_suppliers.inputFiles() == m.bronze_suppliers.inputFiles()  # a finished table is reused
    landed = m.from_landed_bronze()
    assert landed.silver_suppliers.count() == silver and landed.bronze_suppliers is m.bronze_suppliers
