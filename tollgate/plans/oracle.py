"""DuckDB twins of the Spark plans, used as the correctness oracle.

The bronze derivations are the very same SQL text as the Spark side (see
``sources.fixtures``); silver, gold and every check are re-written here
independently in DuckDB SQL.  ``with_ctes(body)`` prefixes a query with the
CTEs it references (transitively).
"""
from __future__ import annotations

import re
from collections.abc import Sequence

from ..operators.transform import DEFAULT_AS_OF
from ..sources import fixtures as fx
from .suite import Check

AS_OF = DEFAULT_AS_OF
WS = r"'^\s+|\s+$'"


def strip(col: str) -> str:
    return f"regexp_replace({col}, {WS}, '', 'g')"


def inlist(values: Sequence[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


CTES: dict[str, str] = {}
CTES["bronze_suppliers"] = fx.bind_duckdb(fx.BRONZE_SUPPLIERS_SQL, supplier="supplier", nation="nation")
CTES["bronze_parts"] = fx.bind_duckdb(fx.BRONZE_PARTS_SQL, part="part", supplier="supplier")
CTES["bronze_work_orders"] = fx.bind_duckdb(fx.BRONZE_WORK_ORDERS_SQL, lineitem="lineitem", orders="orders")
CTES["ss_stage"] = f"""
SELECT supplier_id, {strip('supplier_name')} AS supplier_name, country,
  coalesce(email, 'unknown+' || lower(supplier_id) || '@example.com') AS email, phone,
  CASE WHEN regexp_full_match(contract_start_date, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}')
       THEN substr(contract_start_date, 7, 4) || '-' || substr(contract_start_date, 4, 2) || '-' || substr(contract_start_date, 1, 2)
       ELSE contract_start_date END AS contract_start_date,
  payment_terms, TRY_CAST(quality_rating AS DOUBLE) AS quality_rating, status, source_system, load_timestamp
FROM bronze_suppliers"""


def first_of_key(source: str, key: str, columns: Sequence[str]) -> str:
    """Rows of *source* with 'duplicate_key' for all but the first accepted row of a key, in column order."""
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    return f"""
SELECT * EXCLUDE (reject_reason, rn), CASE WHEN reject_reason IS NULL AND rn > 1 THEN 'duplicate_key' ELSE reject_reason END AS reject_reason
FROM (SELECT *, row_number() OVER (PARTITION BY {key}, reject_reason IS NULL ORDER BY {order}) AS rn FROM {source}) numbered"""


CTES["ss_rules"] = f"""
SELECT *, CASE
  WHEN supplier_id IS NULL THEN 'missing_key'
  WHEN status IS NULL OR status NOT IN ({inlist(fx.SUPPLIER_STATUSES)}) THEN 'invalid_status'
  WHEN NOT coalesce(regexp_full_match(contract_start_date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}'), false)
       OR try_strptime(contract_start_date, '%Y-%m-%d') IS NULL THEN 'invalid_contract_date'
  WHEN quality_rating IS NULL THEN 'invalid_quality_rating'
  WHEN payment_terms IS NULL OR payment_terms NOT IN ({inlist(fx.PAYMENT_TERMS)}) THEN 'invalid_payment_terms'
  WHEN supplier_name IS NULL OR {strip('supplier_name')} = '' THEN 'missing_name'
END AS reject_reason FROM ss_stage"""
CTES["ss_flag"] = first_of_key("ss_rules", "supplier_id", [
    "supplier_id", "supplier_name", "country", "email", "phone", "contract_start_date", "payment_terms", "quality_rating", "status",
    "source_system", "load_timestamp"])
CTES["silver_suppliers"] = f"SELECT * EXCLUDE (reject_reason), DATE '{AS_OF}' AS dq_load_date FROM ss_flag WHERE reject_reason IS NULL"
CTES["sp_rules"] = f"""
SELECT part_id, part_number, coalesce(nullif({strip('part_name')}, ''), part_number) AS part_name, part_category, supplier_id,
  unit_price, unit_of_measure, lead_time_days, is_critical, spec_revision, created_date, source_system,
  CASE WHEN part_id IS NULL THEN 'missing_key'
       WHEN coalesce(unit_price <= 0, true) THEN 'non_positive_price'
       WHEN supplier_id IS NULL THEN 'missing_supplier'
       WHEN supplier_id NOT IN (SELECT supplier_id FROM silver_suppliers) THEN 'orphan_supplier' END AS reject_reason
FROM bronze_parts"""
CTES["sp_stage"] = first_of_key("sp_rules", "part_id", [
    "part_id", "part_number", "part_name", "part_category", "supplier_id", "unit_price", "unit_of_measure", "lead_time_days", "is_critical",
    "spec_revision", "created_date", "source_system"])
CTES["silver_parts"] = f"SELECT * EXCLUDE (reject_reason), DATE '{AS_OF}' AS dq_load_date FROM sp_stage WHERE reject_reason IS NULL"
CTES["sw_rules"] = f"""
SELECT work_order_id, part_id, quantity_ordered, quantity_received, order_date, expected_delivery,
  CASE WHEN status = 'CLOSED' AND actual_delivery IS NULL THEN expected_delivery ELSE actual_delivery END AS actual_delivery,
  unit_cost, total_cost, status, defect_count, source_system, load_timestamp,
  CASE WHEN work_order_id IS NULL THEN 'missing_key'
       WHEN part_id IS NULL THEN 'missing_part'
       WHEN status IS NULL OR status NOT IN ({inlist(fx.WORK_ORDER_STATUSES)}) THEN 'invalid_status'
       WHEN NOT coalesce(regexp_full_match(order_date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}'), false)
            OR try_strptime(order_date, '%Y-%m-%d') IS NULL THEN 'invalid_order_date'
       WHEN part_id NOT IN (SELECT part_id FROM silver_parts) THEN 'orphan_part' END AS reject_reason
FROM bronze_work_orders"""
CTES["sw_stage"] = first_of_key("sw_rules", "work_order_id", [
    "work_order_id", "part_id", "quantity_ordered", "quantity_received", "order_date", "expected_delivery", "actual_delivery", "unit_cost",
    "total_cost", "status", "defect_count", "source_system", "load_timestamp"])
CTES["silver_work_orders"] = f"SELECT * EXCLUDE (reject_reason), DATE '{AS_OF}' AS dq_load_date FROM sw_stage WHERE reject_reason IS NULL"
CTES["quarantine"] = """
SELECT 'suppliers' AS table_name, supplier_id AS record_id, reject_reason FROM ss_flag WHERE reject_reason IS NOT NULL
UNION ALL SELECT 'parts', part_id, reject_reason FROM sp_stage WHERE reject_reason IS NOT NULL
UNION ALL SELECT 'work_orders', work_order_id, reject_reason FROM sw_stage WHERE reject_reason IS NOT NULL"""
_CL = "w.status IN ('CLOSED', 'PARTIAL')"
CTES["gold_agg"] = f"""
SELECT strftime(TRY_CAST(w.order_date AS DATE), '%Y-%m') AS metric_month, p.supplier_id,
  count(DISTINCT CASE WHEN {_CL} THEN w.work_order_id END) AS total_orders,
  CAST(sum(CASE WHEN {_CL} THEN w.quantity_ordered ELSE 0 END) AS BIGINT) AS total_parts_ordered,
  CAST(sum(CASE WHEN {_CL} THEN w.quantity_received ELSE 0 END) AS BIGINT) AS total_parts_received,
  CAST(sum(CASE WHEN {_CL} THEN CAST(w.total_cost AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS total_spend,
  CAST(sum(CASE WHEN {_CL} THEN w.defect_count ELSE 0 END) AS BIGINT) AS defect_count,
  CAST(sum(CASE WHEN {_CL} THEN 1 ELSE 0 END) AS BIGINT) AS closed_lines,
  CAST(sum(CASE WHEN {_CL} THEN CAST(w.actual_delivery <= w.expected_delivery AS INTEGER) ELSE 0 END) AS BIGINT) AS on_time_delivery_count,
  CAST(sum(CASE WHEN {_CL} THEN p.lead_time_days ELSE 0 END) AS BIGINT) AS lead_sum
FROM silver_work_orders w JOIN silver_parts p ON w.part_id = p.part_id
GROUP BY 1, 2"""
CTES["gold_clean"] = f"""
SELECT a.metric_month, a.supplier_id, s.supplier_name, a.total_orders, a.total_parts_ordered, a.total_parts_received,
  a.total_spend, a.defect_count,
  CASE WHEN a.total_parts_received > 0 THEN round(CAST(a.defect_count AS DOUBLE) * 100.0 / CAST(a.total_parts_received AS DOUBLE), 2) ELSE 0.0 END AS defect_rate_pct,
  a.on_time_delivery_count,
  CASE WHEN a.closed_lines > 0 THEN round(CAST(a.on_time_delivery_count AS DOUBLE) * 100.0 / CAST(a.closed_lines AS DOUBLE), 2) ELSE 0.0 END AS on_time_delivery_pct,
  CASE WHEN a.closed_lines > 0 THEN round(CAST(a.lead_sum AS DOUBLE) / CAST(a.closed_lines AS DOUBLE), 2) ELSE 0.0 END AS avg_lead_time_days,
  s.quality_rating AS quality_score, DATE '{AS_OF}' AS dq_load_date
FROM gold_agg a LEFT JOIN silver_suppliers s ON a.supplier_id = s.supplier_id"""
CTES["gold_metrics"] = fx.bind_duckdb(fx.GOLD_DRIFT_SQL, gold="gold_clean")
CTES["silver_agg"] = """
SELECT strftime(TRY_CAST(w.order_date AS DATE), '%Y-%m') AS metric_month, p.supplier_id,
  CAST(sum(CAST(w.total_cost AS DECIMAL(18,2))) AS DOUBLE) AS silver_total_spend,
  CAST(sum(w.defect_count) AS BIGINT) AS silver_defect_count,
  count(DISTINCT w.work_order_id) AS silver_order_count,
  CAST(sum(w.quantity_ordered) AS BIGINT) AS silver_qty_ordered,
  CAST(sum(w.quantity_received) AS BIGINT) AS silver_qty_received
FROM silver_work_orders w JOIN silver_parts p ON w.part_id = p.part_id
WHERE w.status IN ('CLOSED', 'PARTIAL')
GROUP BY 1, 2"""
CTES["runs"] = fx.bind_duckdb(fx.RUNS_SQL, events="events")

_NAMES = list(CTES)


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it needs, in dependency order."""
    needed: set[str] = set()
    stack = [body]
    while stack:
        text = stack.pop()
        for name in _NAMES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                stack.append(CTES[name])
    ordered = [n for n in _NAMES if n in needed]
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + "\n" + body


# ---------------------------------------------------------------------------
# Suites
# ---------------------------------------------------------------------------

def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(float(v)) if isinstance(v, float) else str(v)


def _strptime_guard(fmt: str) -> str:
    from ..functions.text import _translate

    return _translate(fmt)[0]


def row_sql(ch: Check) -> tuple[str, str]:
    c, p = ch.column, ch.params
    if ch.kind == "not_null":
        return "TRUE", f"{c} IS NULL"
    if ch.kind == "null_rate":
        return "TRUE", (f"({c} IS NULL OR {strip(f'CAST({c} AS VARCHAR)')} = '')" if p.get("blank_is_null") else f"{c} IS NULL")
    if ch.kind == "in_set":
        if p.get("null_is_violation"):
            return "TRUE", f"NOT coalesce({c} IN ({inlist(p['values'])}), false)"
        return f"{c} IS NOT NULL", f"{c} NOT IN ({inlist(p['values'])})"
    if ch.kind == "between":
        x = f"TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE)"
        bad = [f"{x} IS NULL"]
        if p.get("min") is not None:
            bad.append(f"{x} < {float(p['min'])!r}")
        if p.get("max") is not None:
            bad.append(f"{x} > {float(p['max'])!r}")
        return f"{c} IS NOT NULL", "(" + " OR ".join(bad) + ")"
    if ch.kind == "match_regex":
        return f"{c} IS NOT NULL", f"NOT regexp_matches(CAST({c} AS VARCHAR), {_sql_lit(p['regex'])})"
    if ch.kind == "strftime":
        fmt = p.get("format", "%Y-%m-%d")
        s = f"CAST({c} AS VARCHAR)"
        return f"{c} IS NOT NULL", f"NOT (regexp_matches({s}, {_sql_lit(_strptime_guard(fmt))}) AND try_strptime({s}, {_sql_lit(fmt)}) IS NOT NULL)"
    if ch.kind == "expression":
        return "TRUE", f"NOT ({p['expr']})"
    if ch.kind == "not_empty":
        return f"{c} IS NOT NULL", f"{strip(f'CAST({c} AS VARCHAR)')} = ''"
    raise ValueError(ch.kind)


def _verdict_sql(ch: Check) -> str:
    if ch.kind == "null_rate":
        thr = float(ch.params.get("threshold", 0.0))
        return f"(CASE WHEN total_rows > 0 THEN CAST(failing_rows AS DOUBLE) / CAST(total_rows AS DOUBLE) ELSE 0.0 END) <= {thr!r}"
    if ch.mostly is not None:
        return (f"coalesce(CASE WHEN evaluated_rows > 0 THEN CAST(evaluated_rows - failing_rows AS DOUBLE) / "
                f"CAST(evaluated_rows AS DOUBLE) END >= {float(ch.mostly)!r}, true)")
    if ch.max_allowed is not None:
        return f"failing_rows <= {int(ch.max_allowed)}"
    return "failing_rows = 0"


def _wrap(ch: Check, layer: str, table: str, inner: str, missing: bool = False) -> str:
    return f"""SELECT '{layer}' AS layer, '{table}' AS table_name, {_sql_lit(ch.rule)} AS rule,
  CAST({_sql_lit(ch.column)} AS VARCHAR) AS column_name, '{ch.severity}' AS severity,
  CAST(total_rows AS BIGINT) AS total_rows, CAST(evaluated_rows AS BIGINT) AS evaluated_rows, CAST(failing_rows AS BIGINT) AS failing_rows,
  round(CASE WHEN evaluated_rows > 0 THEN CAST(evaluated_rows - failing_rows AS DOUBLE) / CAST(evaluated_rows AS DOUBLE) END, 6) AS conforming_ratio,
  CAST({_sql_lit(ch.mostly)} AS DOUBLE) AS mostly, CAST({_sql_lit(ch.max_allowed)} AS BIGINT) AS max_allowed,
  {"false" if missing else _verdict_sql(ch)} AS passed
FROM ({inner}) q"""


def suite_sql(source: str, checks: Sequence[Check], layer: str, table: str, columns: Sequence[str]) -> str:
    """UNION ALL of one SELECT per check over the CTE / table ``source``."""
    parts = []
    cols = set(columns)
    for ch in checks:
        missing = ch.column is not None and ch.column not in cols
        if ch.kind in ("not_null", "null_rate", "in_set", "between", "match_regex", "strftime", "expression", "not_empty"):
            if missing:
                inner = f"SELECT count(*) AS total_rows, 0 AS evaluated_rows, 1 AS failing_rows FROM {source}"
            else:
                ev, bad = row_sql(ch)
                inner = (f"SELECT count(*) AS total_rows, sum(CASE WHEN {ev} THEN 1 ELSE 0 END) AS evaluated_rows, "
                         f"sum(CASE WHEN ({ev}) AND coalesce({bad}, false) THEN 1 ELSE 0 END) AS failing_rows FROM {source}")
        elif ch.kind == "row_count":
            lo, hi = ch.params.get("min"), ch.params.get("max")
            conds = ([f"count(*) < {lo}"] if lo is not None else []) + ([f"count(*) > {hi}"] if hi is not None else []) or ["false"]
            inner = f"SELECT count(*) AS total_rows, 1 AS evaluated_rows, CASE WHEN {' OR '.join(conds)} THEN 1 ELSE 0 END AS failing_rows FROM {source}"
        elif ch.kind in ("columns_match", "required_columns"):
            wanted = list(ch.params["columns"])
            missing = [c for c in wanted if c not in cols]
            extra = [c for c in columns if c not in wanted] if ch.params.get("exact") else []
            inner = f"SELECT count(*) AS total_rows, {len(wanted)} AS evaluated_rows, {len(missing) + len(extra)} AS failing_rows FROM {source}"
        elif ch.kind in ("unique", "unique_values"):
            c = ch.column
            fail = "sum(CASE WHEN n > 1 THEN n ELSE 0 END)" if ch.kind == "unique" else "sum(CASE WHEN n > 1 THEN 1 ELSE 0 END)"
            inner = (f"SELECT (SELECT count(*) FROM {source}) AS total_rows, coalesce(sum(n), 0) AS evaluated_rows, "
                     f"coalesce({fail}, 0) AS failing_rows FROM (SELECT {c}, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}) g")
        elif ch.kind == "relationship":
            c, parent, pk = ch.column, ch.params["parent_sql"], ch.params.get("pk", ch.column)
            inner = (f"SELECT (SELECT count(*) FROM {source}) AS total_rows, count(*) AS evaluated_rows, "
                     f"coalesce(sum(CASE WHEN {c} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL) THEN 1 ELSE 0 END), 0) AS failing_rows "
                     f"FROM {source} WHERE {c} IS NOT NULL")
        else:
            raise ValueError(ch.kind)
        parts.append(_wrap(ch, layer, table, inner, missing))
    return "\nUNION ALL\n".join(parts)
