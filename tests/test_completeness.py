import pytest

from tollgate.operators import completeness as C
from tollgate.operators._common import MissingColumn

from .conftest import collect_set


def test_null_rates_one_row_per_column_and_strict_threshold(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "b"), (4, "c")], "k int, v string")
    rows = {r["column_name"]: r for r in C.null_rates(df, None, 0.25).collect()}
    assert set(rows) == {"k", "v"}
    assert rows["v"]["null_count"] == 1 and rows["v"]["null_rate_pct"] == 25.0
    assert rows["v"]["passed"]  # 25% is not above a 25% threshold
    assert not C.null_rates(df, ["v"], 0.2).first()["passed"]


def test_null_rates_empty_table_and_unknown_column(spark):
    empty = spark.createDataFrame([], "v string")
    r = C.null_rates(empty, [], 0.0).first()
    assert r["total_rows"] == 0 and r["null_rate_pct"] == 0.0 and r["passed"]
    with pytest.raises(MissingColumn):
        C.null_rates(empty, ["nope"])


def test_null_rates_is_one_aggregate(spark, bronze_suppliers):
    plan = C.null_rates(bronze_suppliers)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_row_count_inclusive(spark, bronze_parts):
    assert C.row_count(bronze_parts, 10, 10).first()["passed"]
    assert not C.row_count(bronze_parts, 11).first()["passed"]


def test_empty_strings_null_is_not_empty_and_tabs_are(spark):
    df = spark.createDataFrame([(1, None), (2, "\t "), (3, "x"), (4, "")], "k int, v string")
    assert collect_set(C.empty_strings(df, "k", ["v", "missing"]), "k") == {2, 4}


def test_whitespace_padding_catches_tabs_and_trailing(spark, bronze_suppliers):
    df = spark.createDataFrame([(1, "a\t"), (2, " b"), (3, "c"), (4, None)], "k int, v string")
    assert collect_set(C.whitespace_padding(df, "k", ["v"]), "k") == {1, 2}
    assert collect_set(C.whitespace_padding(bronze_suppliers, "supplier_id", ["supplier_name"]), "supplier_id") == {"S02", "S05"}


def test_pk_unique_groups_nulls_unless_ignored(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert collect_set(C.pk_unique(df, "k"), "k", "n_rows") == {("a", 2), (None, 2)}
    assert collect_set(C.pk_unique(df, "k", ignore_nulls=True), "k") == {"a"}


def test_required_columns_runs_no_job(bronze_suppliers):
    assert C.required_columns(bronze_suppliers, ["supplier_id", "region"]) == ["region"]


def test_conditional_not_null(spark, bronze_work_orders):
    from pyspark.sql import functions as F

    got = C.conditional_not_null(bronze_work_orders, "work_order_id", F.col("status") == "CLOSED", "actual_delivery")
    assert collect_set(got, "work_order_id") == {"W11"}


def test_no_applicable_columns_gives_empty_typed_result(spark, bronze_suppliers):
    out = C.empty_strings(bronze_suppliers, "supplier_id", ["not_there"])
    assert out.columns == ["supplier_id", "column_name"] and out.count() == 0
    assert C.whitespace_padding(bronze_suppliers, "supplier_id", []).count() == 0
