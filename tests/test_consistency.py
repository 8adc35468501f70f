import datetime as dt

from tollgate.operators import consistency as K

from .conftest import collect_set


def test_accepted_values_counts_bad_values_and_null_semantics(spark):
    df = spark.createDataFrame([("A",), ("X",), ("X",), (None,)], "s string")
    assert collect_set(K.accepted_values(df, "s", ["A"]), "value", "n_rows") == {("X", 2), (None, 1)}
    assert collect_set(K.accepted_values(df, "s", ["A"], null_is_violation=False), "value", "n_rows") == {("X", 2)}
    only_null = spark.createDataFrame([("A",), (None,)], "s string")
    assert collect_set(K.accepted_values(only_null, "s", ["A"]), "value", "n_rows") == {(None, 1)}
    assert K.accepted_values_rows(only_null, "s", "s", ["A"]).count() == 1
    assert K.accepted_values_rows(only_null, "s", "s", ["A"], null_is_violation=False).count() == 0


def test_numeric_range_coerces_text(spark, bronze_suppliers):
    got = collect_set(K.numeric_range(bronze_suppliers, "supplier_id", "quality_rating", 1.0, 5.0), "supplier_id")
    assert got == set()  # the non-numeric rating is null and nulls are allowed
    got = collect_set(K.numeric_range(bronze_suppliers, "supplier_id", "quality_rating", 1.0, 5.0, allow_null=False), "supplier_id")
    assert got == {"S99"}


def test_date_format_matches_strptime(spark):
    vals = ["2024-01-05", "2024-1-5", "15/06/2022", "-999", "24-1-5", "12024-01-05", "2024-02-30", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k int, v string")
    bad = {vals[k] for k in collect_set(K.date_format(df, "k", "v", "%Y-%m-%d"), "k")}
    assert bad == {"15/06/2022", "-999", "24-1-5", "12024-01-05", "2024-02-30"}
    months = spark.createDataFrame([(1, "2024-03"), (2, "2024/03")], "k int, v string")
    assert collect_set(K.date_format(months, "k", "v", "%Y-%m"), "k") == {2}


def test_email_format(spark, bronze_suppliers):
    assert collect_set(K.email_format(bronze_suppliers, "supplier_id", "email"), "supplier_id") == {"S06"}


def test_referential_integrity_text_keys_and_nulls(spark, bronze_parts, bronze_suppliers):
    got = collect_set(K.referential_integrity(bronze_parts, "part_id", "supplier_id", bronze_suppliers, "supplier_id"), "part_id")
    assert got == {"P23"}
    strict = K.referential_integrity(bronze_parts, "part_id", "supplier_id", bronze_suppliers, "supplier_id", allow_null=False)
    assert collect_set(strict, "part_id") == {"P21", "P23"}
    child = spark.createDataFrame([(1, 7), (2, 8)], "k int, fk int")
    parent = spark.createDataFrame([("7",)], "pk string")
    assert collect_set(K.referential_integrity(child, "k", "fk", parent, "pk"), "k") == {2}


def test_no_future_dates_against_as_of(spark, bronze_suppliers):
    got = collect_set(K.no_future_dates(bronze_suppliers, "supplier_id", "contract_start_date", as_of="2024-05-01"), "supplier_id")
    assert got == {"S07"}
    assert K.no_future_dates(bronze_suppliers, "supplier_id", "contract_start_date", as_of=dt.date(2031, 1, 1)).count() == 0
