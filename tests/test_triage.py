from pyspark.sql import functions as F

from tollgate.operators import triage as TR


def _one(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(TR.extract_error_class(F.col("t")).alias("c"), TR.extract_error_message(F.col("t")).alias("m")).first()
    return r["c"], r["m"]


def test_error_class_first_line_and_list_order(spark):
    assert _one(spark, "x\nE   KeyError and TypeError here\nValueError")[0] == "KeyError"
    assert _one(spark, "ModuleNotFoundError: ImportError inside")[0] == "ModuleNotFoundError"
    assert _one(spark, "boom\nduckdb.CatalogException: Table missing")[0] == "CatalogException"
    assert _one(spark, "ZeroDivisionError: x")[0] == "UnknownError"


def test_error_message(spark):
    assert _one(spark, "def f():\nE       AssertionError: 3 rows\nmore")[1] == "AssertionError: 3 rows"
    assert _one(spark, "first\nlast line  \n   \n")[1] == "last line"
    assert _one(spark, "")[1] == ""


def test_layer_and_decisions(spark):
    rows = [(1, "tests/gold/test_x.py::t", "silver,foo", "failed", "E   AssertionError: bad"),
            (2, "tests/bronze/test_y.py::t", "", "failed", "E   KeyError: 'k'"),
            (3, "other/test_z.py::t", "", "failed", "duckdb.BinderException: no column"),
            (4, "tests/sql/test_q.py::t", "", "passed", ""),
            (5, "x/integration/t.py", "", "failed", "AssertionError")]
    runs = spark.createDataFrame(rows, "run_id int, node_id string, keywords string, outcome string, longrepr string")
    got = {r["run_id"]: r for r in TR.triage(runs).collect()}
    assert got[1]["layer"] == "silver" and got[1]["decision"] == "must_fail"
    assert got[1]["reason"] == TR.ASSERTION_REASONS["silver"]
    assert got[2]["layer"] == "bronze" and got[2]["decision"] == "healable" and got[2]["reason"] == TR.INFRA_REASON
    assert got[3]["layer"] == "unknown" and got[3]["reason"] == "BinderException is an infrastructure-class error."
    assert got[4]["decision"] == "pass" and got[4]["reason"] == ""
    assert got[5]["layer"] == "integration"
    totals = {r["decision"]: r["n_runs"] for r in TR.result_totals(TR.triage(runs)).collect()}
    assert totals == {"must_fail": 2, "healable": 2, "pass": 1}
