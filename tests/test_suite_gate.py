import pytest
from pyspark.sql import functions as F

from tollgate.plans import expectations as EX
from tollgate.plans import suite as S

from .conftest import collect_set


def _by_rule(res):
    return {(r["rule"], r["column_name"]): r for r in res.collect()}


def test_bronze_supplier_suite_verdicts(spark, bronze_suppliers):
    res = _by_rule(S.run_suite(bronze_suppliers, EX.SUITES["bronze_suppliers"], "suppliers", "bronze"))
    assert not res[("expect_column_values_to_be_in_set", "status")]["passed"]  # LEGACY_SYSTEM, no mostly
    email_nn = res[("expect_column_values_to_not_be_null", "email")]
    assert email_nn["failing_rows"] == 1 and not email_nn["passed"]  # 7/8 = 0.875 < mostly 0.9
    assert res[("expect_table_columns_to_match_set", None)]["passed"]
    assert not res[("expect_table_row_count_to_be_between", None)]["passed"]  # 8 rows < 10


def test_fused_suite_reads_table_once(spark, bronze_suppliers):
    checks = [c for c in EX.SUITES["bronze_suppliers"] if c.kind in S.ROW_KINDS]
    plan = S.run_suite(bronze_suppliers, checks, "suppliers", "bronze")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.count("LogicalRDD") == 1


def test_mostly_budget_and_missing_column(spark, bronze_parts):
    checks = [S.Check("between", "unit_price", {"min": 0.01}, mostly=0.9),
              S.Check("between", "unit_price", {"min": 0.01}, max_allowed=1, name="budget"),
              S.Check("not_null", "nope", name="missing")]
    res = _by_rule(S.run_suite(bronze_parts, checks, "parts", "bronze"))
    assert res[("between", "unit_price")]["passed"]  # 9/10 ≥ 0.9
    assert res[("budget", "unit_price")]["passed"]
    assert not res[("missing", "nope")]["passed"]


def test_severity_warn_does_not_block_gate(spark, bronze_suppliers):
    checks = [S.Check("in_set", "status", {"values": ["ACTIVE"]}, severity="warn"), S.Check("not_null", "supplier_id")]
    gate = S.run_gate(S.run_suite(bronze_suppliers, checks, "suppliers", "bronze")).first()
    assert gate["gate_passed"] and gate["warnings"] == 1
    assert S.gate_verdict(S.run_suite(bronze_suppliers, checks, "suppliers", "bronze"))


def test_unique_relationship_and_unexpected_rows(spark, bronze_parts, bronze_suppliers):
    dup = bronze_parts.unionByName(bronze_parts.limit(1))
    checks = [S.Check("unique", "part_id"), S.Check("unique_values", "part_id"),
              S.Check("relationship", "supplier_id", {"parent": bronze_suppliers, "pk": "supplier_id"})]
    res = _by_rule(S.run_suite(dup, checks, "parts", "bronze"))
    assert res[("unique", "part_id")]["failing_rows"] == 2
    assert res[("unique_values", "part_id")]["failing_rows"] == 1
    rel = res[("relationship", "supplier_id")]
    assert (rel["evaluated_rows"], rel["failing_rows"]) == (10, 1)
    rows = S.unexpected_rows(bronze_parts, EX.SUITES["bronze_parts"], ["part_id"])
    assert ("P20", "unit_price") in collect_set(rows, "part_id", "column_name")


def test_empty_suite_and_no_row_checks(spark, bronze_parts):
    res = S.run_suite(bronze_parts, [], "parts", "bronze")
    assert res.columns == S.RESULT_COLUMNS and res.count() == 0
    rows = S.unexpected_rows(bronze_parts, [S.Check("unique", "part_id"), S.Check("row_count", None, {"min": 99})], ["part_id"])
    assert rows.columns == ["part_id", "rule", "column_name", "value"] and rows.count() == 0


def test_missing_column_fails_whatever_is_tolerated(spark):
    df = spark.range(100).select(F.col("id").alias("k"))
    checks = [S.Check("not_null", "gone", mostly=0.1), S.Check("not_null", "gone", max_allowed=5), S.Check("null_rate", "gone", {"threshold": 1.0}),
              S.Check("unique", "gone", max_allowed=5), S.Check("bad_values", "gone", {"values": ["a"]}, max_allowed=5), S.Check("not_null", "gone"),
              S.Check("expression", None, {"expr": "gone > 0"}, max_allowed=5)]
    rows = S.run_suite(df, checks).collect()
    assert len(rows) == len(checks) and not any(r["passed"] for r in rows)
    assert not S.gate_verdict(S.run_suite(df, [*checks, S.Check("not_null", "k")]))


def test_budget_of_distinct_bad_values(spark):
    df = spark.createDataFrame([("A",), ("B",), ("X",), ("X",), ("X",), (None,)], "v string")
    row = S.run_suite(df, [S.Check("bad_values", "v", {"values": ["A", "B"]}, max_allowed=1)]).first()
    assert (row["total_rows"], row["evaluated_rows"], row["failing_rows"], row["passed"]) == (6, 5, 1, True)
    padded = spark.createDataFrame([(" a",), ("b\t",), ("c d",), (None,)], "v string")
    assert S.run_suite(padded, [S.Check("not_padded", "v")]).first()["failing_rows"] == 2


def test_key_checks_share_one_scan_and_one_shuffle(spark, bronze_parts, bronze_suppliers):
    checks = [S.Check("unique", "part_id"), S.Check("unique_values", "part_number"), S.Check("bad_values", "unit_of_measure", {"values": ["EA"]}),
              S.Check("unique", "part_name"), S.Check("unique", "gone", name="gone")]
    plan = S.run_suite(bronze_parts, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("Exchange hashpartitioning") == 1
    res = {r["rule"]: r for r in S.run_suite(bronze_parts, checks).collect()}
    assert len(res) == 4 and not res["gone"]["passed"] and res["gone"]["total_rows"] == 10
    checks.append(S.Check("relationship", "supplier_id", {"parent": bronze_suppliers}))
    plan = S.run_suite(bronze_parts, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("part_id#") and plan.count("Generate") == 2  # the table's pairs, the result rows
    with pytest.raises(ValueError, match="unknown kinds"):
        S.run_suite(bronze_parts, [S.Check("uniqe", "part_id")])


def test_rows_of_shuffled_checks(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"v{i}", i % 7, float(i % 5) * (-1 if i == 5 else 1)) for i in range(300)] + [(300, None, None, None), (7, "x", 1, 0.5)]
    df = spark.createDataFrame(rows, "id int, v string, fk int, x double")
    parent = spark.createDataFrame([(k,) for k in (0, 1, 2, 2, 4)] + [(None,)], "pk long")
    checks = [S.Check("unique", "v"), S.Check("unique_values", "id"), S.Check("relationship", "fk", {"parent": parent, "pk": "pk"}),
              S.Check("bad_values", "fk", {"values": [0, 1, 2, 3, 4, 5]}), S.Check("not_null", "v"), S.Check("unique", "gone")]
    got = sorted((r.id, r.rule, r.value) for r in S.unexpected_rows(df, checks, ["id"]).collect())
    want = [(i, "unique", "hot") for i in range(0, 300, 3)] + [(7, "unique_values", "7")] * 2 + [(300, "not_null", None)]
    want += [(i, "relationship", str(fk)) for i, _, fk, _ in rows if fk in (3, 5, 6)] + [(i, "bad_values", "6") for i, _, fk, _ in rows if fk == 6]
    assert got == sorted(want)
    counted = {r["rule"]: r["failing_rows"] for r in S.run_suite(df, checks[:4]).collect()}
    assert counted == {"unique": 100, "unique_values": 1, "relationship": sum(fk in (3, 5, 6) for *_, fk, _ in rows), "bad_values": 1}
    zeros = spark.createDataFrame([(0.0, bytes([255]), [1]), (-0.0, bytes([254]), [1]), (1.5, None, None)], "x double, b binary, a array<int>")
    res = {r["column_name"]: r["failing_rows"] for r in S.run_suite(zeros, [S.Check("unique", c) for c in "xba"]).collect()}
    assert res == {"x": 2, "b": 0, "a": 2}


def test_suite_rides_on_the_write(spark, bronze_parts, monkeypatch, tmp_path):
    checks = [c for c in EX.SUITES["bronze_parts"]] + [S.Check("not_null", "gone", name="gone"), S.Check("unique", "part_name")]
    want = {tuple(r) for r in S.run_suite(bronze_parts, checks, "parts", "bronze").collect()}
    base = f"/tmp/tollgate-onwrite-{tmp_path.name}-{id(checks)}"
    out, results = S.write_with_suite(bronze_parts, base + "a", checks, "parts", "bronze")
    assert {tuple(r) for r in results.collect()} == want and out.count() == 10
    only = [c for c in checks if c.kind in S.ROW_KINDS]
    _, results = S.write_with_suite(bronze_parts, base + "b", only, "parts", "bronze")
    assert "Scan" not in results._jdf.queryExecution().executedPlan().toString().replace("Scan OneRowRelation", "")  # no scan beyond the write's
    assert {tuple(r) for r in results.collect()} == {tuple(r) for r in S.run_suite(bronze_parts, only, "parts", "bronze").collect()}
    # a task whose metrics counted twice
    monkeypatch.setattr(S.Observation, "get", property(lambda self: {"__total": 11}))
    _, results = S.write_with_suite(bronze_parts, base + "c", checks, "parts", "bronze")
    assert {tuple(r) for r in results.collect()} == want
