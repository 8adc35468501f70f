"""The reference's expectation suites, dbt schema tests and test budgets as check lists.

Values below are fixed values that must equal the reference's parameters.
Suites are data: ``run_suite(df, SUITES[name], ...)`` compiles each into one
fused aggregation plus one shuffle per uniqueness / relationship check.
"""
from __future__ import annotations

from ..sources.fixtures import PART_CATEGORIES, PAYMENT_TERMS, SOURCE_SYSTEMS, SUPPLIER_STATUSES, UNITS_OF_MEASURE, WORK_ORDER_STATUSES
from .suite import Check

# Column sets, country codes and the e-mail / month patterns of the suites.
BRONZE_SUPPLIER_COLUMNS = ["supplier_id", "supplier_name", "country", "email", "phone", "contract_start_date",
                           "payment_terms", "quality_rating", "status", "source_system", "load_timestamp"]
SILVER_SUPPLIER_COLUMNS = BRONZE_SUPPLIER_COLUMNS + ["dq_load_date"]
COUNTRIES = ["US", "FR", "GB", "CA", "DE", "JP", "AU"]
EMAIL_REGEX = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
MONTH_REGEX = r"^\d{4}-\d{2}$"
GOLD_REQUIRED_COLUMNS = ["metric_month", "supplier_id", "supplier_name", "total_orders", "total_parts_ordered",
                         "total_parts_received", "total_spend", "defect_count", "defect_rate_pct", "on_time_delivery_count",
                         "on_time_delivery_pct", "avg_lead_time_days", "quality_score", "dq_load_date"]


def _nn(col, mostly=None):
    return Check("not_null", col, mostly=mostly, name="expect_column_values_to_not_be_null")


def _uniq(col):
    return Check("unique", col, name="expect_column_values_to_be_unique")


def _in(col, values, mostly=None):
    return Check("in_set", col, {"values": list(values)}, mostly=mostly, name="expect_column_values_to_be_in_set")


def _between(col, lo=None, hi=None, mostly=None):
    return Check("between", col, {"min": lo, "max": hi}, mostly=mostly, name="expect_column_values_to_be_between")


def _regex(col, rx, mostly=None):
    return Check("match_regex", col, {"regex": rx}, mostly=mostly, name="expect_column_values_to_match_regex")


def _strf(col, fmt):
    return Check("strftime", col, {"format": fmt}, name="expect_column_values_to_match_strftime_format")


def _rows(lo, hi):
    return Check("row_count", None, {"min": lo, "max": hi}, name="expect_table_row_count_to_be_between")


def _colset(cols, exact):
    return Check("columns_match", None, {"columns": list(cols), "exact": exact}, name="expect_table_columns_to_match_set")


SUITES: dict[str, list[Check]] = {
    "bronze_suppliers": [
        _colset(BRONZE_SUPPLIER_COLUMNS, False), _rows(10, 1000), _nn("supplier_id"), _uniq("supplier_id"),
        _nn("supplier_name"), _nn("status"), _in("status", SUPPLIER_STATUSES), _in("payment_terms", PAYMENT_TERMS, 0.95),
        _between("quality_rating", 1.0, 5.0, 0.95), _nn("email", 0.9), _regex("email", EMAIL_REGEX, 0.9),
        _nn("source_system"), _in("source_system", SOURCE_SYSTEMS),
    ],
    "bronze_parts": [
        _rows(25, 500), _nn("part_id"), _uniq("part_id"), _nn("part_number"), _nn("part_name", 0.95),
        _in("part_category", PART_CATEGORIES), _between("unit_price", 0.01, None, 0.97), _between("lead_time_days", 1, 365),
        _in("unit_of_measure", UNITS_OF_MEASURE), _strf("created_date", "%Y-%m-%d"),
    ],
    "silver_suppliers": [
        _colset(SILVER_SUPPLIER_COLUMNS, True), _rows(14, 16), _nn("supplier_id"), _uniq("supplier_id"), _nn("supplier_name"),
        _nn("email"), _regex("email", EMAIL_REGEX), _in("status", SUPPLIER_STATUSES), _in("payment_terms", PAYMENT_TERMS),
        _in("country", COUNTRIES), _between("quality_rating", 1.0, 5.0), _strf("contract_start_date", "%Y-%m-%d"),
        _nn("dq_load_date"),
    ],
    "silver_parts": [
        _rows(25, 30), _nn("part_id"), _uniq("part_id"), _nn("part_name"), _nn("supplier_id"),
        _in("part_category", PART_CATEGORIES), _between("unit_price", 0.01), _between("lead_time_days", 1, 365),
        _strf("created_date", "%Y-%m-%d"), _nn("dq_load_date"),
    ],
    "gold_production": [
        _rows(10, 10000), _nn("supplier_id"), _nn("metric_month"), _regex("metric_month", MONTH_REGEX),
        _between("defect_rate_pct", 0.0, 100.0), _between("on_time_delivery_pct", 0.0, 100.0),
        _between("quality_score", 1.0, 5.0), _between("total_spend", 0.0), _between("defect_count", 0),
        _between("avg_lead_time_days", 0.0), _nn("total_spend"), _nn("quality_score"),
    ],
}

# Checkpoints: layer → (suite, table).  Gold and work orders have none.
CHECKPOINTS = {
    "bronze": [("bronze_suppliers", "suppliers"), ("bronze_parts", "parts")],
    "silver": [("silver_suppliers", "suppliers"), ("silver_parts", "parts")],
}

# Known-defect budgets of the bronze tests: pass while failures ≤ max_allowed
# (status and payment terms count distinct bad values, the others rows).
BRONZE_BUDGETS: dict[str, list[Check]] = {
    "suppliers": [
        Check("bad_values", "status", {"values": SUPPLIER_STATUSES}, max_allowed=1, name="status_budget"),
        Check("bad_values", "payment_terms", {"values": PAYMENT_TERMS}, max_allowed=1, name="payment_terms_budget"),
        Check("strftime", "contract_start_date", {"format": "%Y-%m-%d"}, max_allowed=2, name="contract_date_budget"),
        Check("not_padded", "supplier_name", max_allowed=1, name="padded_name_budget"),
    ],
    "parts": [
        Check("between", "unit_price", {"min": 0.01}, max_allowed=1, name="price_budget"),
    ],
    "work_orders": [
        Check("expression", None, {"expr": "NOT (status = 'CLOSED' AND actual_delivery IS NULL)"}, max_allowed=1,
              name="closed_without_delivery_budget"),
    ],
}

# dbt: declared per-layer null-rate policy (not referenced by any model).
LAYER_NULL_VARS = {"bronze": 0.10, "silver": 0.00}

# dbt expression_is_true tests on gold (column → expression that must hold).
GOLD_EXPRESSIONS = {
    "total_orders": "total_orders >= 0",
    "total_parts_ordered": "total_parts_ordered >= 0",
    "total_parts_received": "total_parts_received >= 0",
    "total_spend": "total_spend >= 0",
    "defect_rate_pct": "defect_rate_pct >= 0 AND defect_rate_pct <= 100",
    "on_time_delivery_pct": "on_time_delivery_pct >= 0 AND on_time_delivery_pct <= 100",
    "avg_lead_time_days": "avg_lead_time_days >= 0",
    "quality_score": "quality_score >= 1 AND quality_score <= 5",
}


def _declared(not_null=(), unique=(), accepted=None, not_empty=(), warn=(), expressions=(), relations=()):
    """Checks of one model: columns by kind of test; tests named in *warn* ("kind:column") only warn."""
    tests = [("not_null", c, {}) for c in not_null] + [("unique_values", c, {}) for c in unique]
    tests += [("in_set", c, {"values": list(v)}) for c, v in (accepted or {}).items()] + [("not_empty", c, {}) for c in not_empty]
    tests += [("expression", None, {"expr": GOLD_EXPRESSIONS[c]}) for c in expressions]
    names = {"unique_values": "unique", "in_set": "accepted_values", "not_empty": "not_empty_string", "expression": "expression_is_true"}
    checks = [Check(k, c, p, severity="warn" if f"{k}:{c}" in warn else "error", name=names.get(k, k)) for k, c, p in tests]
    return checks, list(relations)


# The declared schema tests of every model (fixed values): checks, and (column, parent model, parent column) of its relationships.
DECLARED_TESTS = {
    "bronze_suppliers": _declared(
        ["supplier_id", "supplier_name", "status", "quality_rating", "source_system"], ["supplier_id"],
        {"status": SUPPLIER_STATUSES, "payment_terms": PAYMENT_TERMS, "source_system": SOURCE_SYSTEMS},
        warn=("in_set:status", "in_set:payment_terms", "not_null:quality_rating")),
    "bronze_parts": _declared(["part_id", "part_number"], ["part_id"], {"part_category": PART_CATEGORIES, "unit_of_measure": UNITS_OF_MEASURE}),
    "bronze_work_orders": _declared(["work_order_id", "part_id"], ["work_order_id"], {"status": WORK_ORDER_STATUSES}),
    "silver_suppliers": _declared(
        ["supplier_id", "supplier_name", "email", "country", "status", "dq_load_date"], ["supplier_id"],
        {"country": COUNTRIES, "status": SUPPLIER_STATUSES, "payment_terms": PAYMENT_TERMS}, not_empty=["supplier_name"]),
    "silver_parts": _declared(
        ["part_id", "part_name", "part_category", "supplier_id", "unit_price", "dq_load_date"], ["part_id"],
        {"part_category": PART_CATEGORIES, "unit_of_measure": UNITS_OF_MEASURE}, not_empty=["part_name"],
        relations=[("supplier_id", "silver_suppliers", "supplier_id")]),
    "silver_work_orders": _declared(
        ["work_order_id", "part_id", "status", "dq_load_date"], ["work_order_id"], {"status": WORK_ORDER_STATUSES},
        relations=[("part_id", "silver_parts", "part_id")]),
    "gold_metrics": _declared(
        ["metric_month", "supplier_id", "supplier_name", *GOLD_EXPRESSIONS, "dq_load_date"], expressions=list(GOLD_EXPRESSIONS),
        relations=[("supplier_id", "silver_suppliers", "supplier_id")]),
}

# What silver work orders must hold before gold is built.
SILVER_ORDER_GATE = [
    Check("not_null", "work_order_id", name="not_null"), Check("unique", "work_order_id", name="unique"), Check("not_null", "part_id", name="not_null"),
    Check("in_set", "status", {"values": WORK_ORDER_STATUSES, "null_is_violation": True}, name="accepted_values"),
    Check("strftime", "order_date", {"format": "%Y-%m-%d"}, name="iso_date"),
    Check("expression", None, {"expr": "NOT (status = 'CLOSED' AND actual_delivery IS NULL)"}, name="closed_has_delivery"),
]
