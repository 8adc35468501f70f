"""Reference-shaped bronze tables derived from the driver's TPC-H-style tables.

The driver's tables are clean, so checks would be vacuous on them.  These views
re-shape them into the supply-chain schema the checks are written for
(suppliers, parts, work orders) and seed deterministic defects from the keys:
padded and blank names, null and malformed e-mails, DD/MM/YYYY and sentinel
dates, out-of-set statuses, non-numeric ratings, negative prices, orphan and
null foreign keys, CLOSED orders without delivery, received > ordered.

Every row of the source tables is kept; modulo expressions only decide which
rows carry a defect, never which rows are read.

The SQL text is written in the subset shared by Spark SQL and DuckDB so the
same derivation feeds both the Spark job and the DuckDB oracle.  ``{name}``
placeholders are bound to DataFrames on the Spark side
(``spark.sql(text, name=df)``) and to table names on the DuckDB side.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The domains of the reference's supply-chain tables.
SUPPLIER_STATUSES = ["ACTIVE", "INACTIVE", "PROBATION", "SUSPENDED"]
PAYMENT_TERMS = ["NET30", "NET45", "NET60", "NET90"]
PART_CATEGORIES = ["AVIONICS", "PROPULSION", "AIRFRAME", "LANDING_GEAR", "HYDRAULIC", "ELECTRICAL", "INTERIOR", "SAFETY"]
UNITS_OF_MEASURE = ["EA", "SET", "KIT", "LB", "FT", "IN"]
WORK_ORDER_STATUSES = ["OPEN", "CLOSED", "PARTIAL", "CANCELLED"]
SOURCE_SYSTEMS = ["ERP_SAP", "LEGACY_SYSTEM", "MDM_PROFISEE", "MANUAL_ENTRY"]


def _case(expr: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


BRONZE_SUPPLIERS_SQL = f"""
SELECT
  'SUP' || CAST(CASE WHEN s.s_suppkey % 83 = 21 THEN s.s_suppkey - 1 ELSE s.s_suppkey END AS STRING) AS supplier_id,
  CASE WHEN s.s_suppkey % 150 = 1 THEN '   '
       WHEN s.s_suppkey % 40 = 0 THEN '  ' || s.s_name || ' '
       ELSE s.s_name END AS supplier_name,
  n.n_name AS country,
  CASE WHEN s.s_suppkey % 30 = 2 THEN NULL
       WHEN s.s_suppkey % 70 = 5 THEN 'bad mail'
       ELSE 'sup' || CAST(s.s_suppkey AS STRING) || '@example.com' END AS email,
  '+1-555-' || CAST(1000 + s.s_suppkey % 9000 AS STRING) AS phone,
  CASE WHEN s.s_suppkey % 500 = 11 THEN '-999'
       WHEN s.s_suppkey % 41 = 3 THEN '2031-01-15'
       WHEN s.s_suppkey % 50 = 7 THEN
            lpad(CAST(day(DATE '2015-01-01' + CAST(s.s_suppkey % 3000 AS INTEGER)) AS STRING), 2, '0') || '/' ||
            lpad(CAST(month(DATE '2015-01-01' + CAST(s.s_suppkey % 3000 AS INTEGER)) AS STRING), 2, '0') || '/' ||
            CAST(year(DATE '2015-01-01' + CAST(s.s_suppkey % 3000 AS INTEGER)) AS STRING)
       ELSE CAST(DATE '2015-01-01' + CAST(s.s_suppkey % 3000 AS INTEGER) AS STRING) END AS contract_start_date,
  CASE WHEN s.s_suppkey % 61 = 0 THEN 'NET15'
       WHEN s.s_suppkey % 67 = 0 THEN NULL
       ELSE {_case('s.s_suppkey % 4', PAYMENT_TERMS)} END AS payment_terms,
  CASE WHEN s.s_suppkey % 89 = 0 THEN 'INACTIVE'
       WHEN s.s_suppkey % 43 = 0 THEN '0.5'
       ELSE CAST(1 + CAST(floor((s.s_acctbal + 999.99) / 2750.0) AS BIGINT) AS STRING) || '.' ||
            CAST(CAST(floor((s.s_acctbal + 999.99) / 275.0) AS BIGINT) % 10 AS STRING) END AS quality_rating,
  CASE WHEN s.s_suppkey % 211 = 0 THEN 'LEGACY_SYSTEM'
       ELSE {_case('s.s_suppkey % 4', SUPPLIER_STATUSES)} END AS status,
  {_case('s.s_suppkey % 4', SOURCE_SYSTEMS)} AS source_system,
  '2024-01-15 06:00:00' AS load_timestamp
FROM {{supplier}} s LEFT JOIN {{nation}} n ON s.s_nationkey = n.n_nationkey
"""

BRONZE_PARTS_SQL = f"""
SELECT
  'PART' || CAST(p_partkey AS STRING) AS part_id,
  'PN-' || CAST(100000 + p_partkey AS STRING) AS part_number,
  CASE WHEN p_partkey % 150 = 1 THEN '  ' ELSE p_name END AS part_name,
  {_case('p_partkey % 8', PART_CATEGORIES)} AS part_category,
  CASE WHEN p_partkey % 223 = 0 THEN NULL
       WHEN p_partkey % 211 = 0 THEN 'SUPXXX'
       ELSE 'SUP' || CAST(p_partkey % (SELECT count(*) FROM {{supplier}}) AS STRING) END AS supplier_id,
  CASE WHEN p_partkey % 97 = 0 THEN -p_retailprice ELSE p_retailprice END AS unit_price,
  {_case('p_partkey % 6', UNITS_OF_MEASURE)} AS unit_of_measure,
  CASE WHEN p_partkey % 101 = 0 THEN CAST(400 AS BIGINT) ELSE CAST(p_size * 7 AS BIGINT) END AS lead_time_days,
  CASE WHEN p_partkey % 307 = 0 THEN NULL ELSE p_partkey % 5 = 0 END AS is_critical,
  'R' || CAST(p_partkey % 5 AS STRING) AS spec_revision,
  CAST(DATE '2018-01-01' + CAST(p_partkey % 1500 AS INTEGER) AS STRING) AS created_date,
  {_case('p_partkey % 4', SOURCE_SYSTEMS)} AS source_system
FROM {{part}}
"""

BRONZE_WORK_ORDERS_SQL = f"""
SELECT
  'WO-' || CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) AS work_order_id,
  CASE WHEN (l.l_orderkey + l.l_linenumber) % 499 = 0 THEN 'PARTXXX'
       WHEN (l.l_orderkey + l.l_linenumber) % 997 = 1 THEN 'PARTYYY'
       WHEN (l.l_orderkey + l.l_linenumber) % 601 = 2 THEN NULL
       ELSE 'PART' || CAST(l.l_partkey AS STRING) END AS part_id,
  CAST(l.l_quantity AS BIGINT) AS quantity_ordered,
  CASE WHEN (l.l_orderkey + l.l_linenumber) % 307 = 0 THEN CAST(l.l_quantity AS BIGINT) + 5
       WHEN o.o_orderstatus = 'O' THEN CAST(0 AS BIGINT)
       WHEN o.o_orderstatus = 'P' THEN CAST(floor(l.l_quantity / 2) AS BIGINT)
       ELSE CAST(l.l_quantity AS BIGINT) END AS quantity_received,
  CASE WHEN (l.l_orderkey + l.l_linenumber) % 701 = 3 THEN '31/12/1995'
       ELSE CAST(CAST(o.o_orderdate AS DATE) AS STRING) END AS order_date,
  CAST(CAST(CAST(o.o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE) AS STRING) AS expected_delivery,
  CASE WHEN o.o_orderstatus = 'O' THEN NULL
       WHEN (l.l_orderkey + l.l_linenumber) % 401 = 0 THEN NULL
       ELSE CAST(CAST(l.l_shipdate AS DATE) AS STRING) END AS actual_delivery,
  l.l_extendedprice / NULLIF(l.l_quantity, 0) AS unit_cost,
  l.l_extendedprice AS total_cost,
  CASE WHEN o.o_orderstatus = 'F' THEN 'CLOSED'
       WHEN o.o_orderstatus = 'P' THEN 'PARTIAL'
       WHEN l.l_orderkey % 53 = 0 THEN 'CANCELLED'
       ELSE 'OPEN' END AS status,
  CASE WHEN l.l_returnflag = 'R' AND o.o_orderstatus <> 'O' THEN CAST(floor(l.l_quantity / 10) AS BIGINT)
       ELSE CAST(0 AS BIGINT) END AS defect_count,
  {_case('l.l_linenumber % 4', SOURCE_SYSTEMS)} AS source_system,
  '2024-01-15 06:00:00' AS load_timestamp
FROM {{lineitem}} l JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey
"""

# The gold table as loaded: build_gold's output with deterministic drift seeded
# per (month, supplier) so reconciliation and KPI checks have findings.
GOLD_DRIFT_SQL = """
SELECT
  metric_month,
  CASE WHEN (CAST(substr(supplier_id, 4) AS BIGINT) + CAST(substr(metric_month, 6, 2) AS BIGINT)) % 37 = 0
       THEN 'SUPX' || substr(supplier_id, 4) ELSE supplier_id END AS supplier_id,
  supplier_name,
  CASE WHEN (CAST(substr(supplier_id, 4) AS BIGINT) + CAST(substr(metric_month, 6, 2) AS BIGINT)) % 23 = 0
       THEN total_orders + 1 ELSE total_orders END AS total_orders,
  total_parts_ordered,
  CASE WHEN (CAST(substr(supplier_id, 4) AS BIGINT) + CAST(substr(metric_month, 6, 2) AS BIGINT)) % 31 = 0
       THEN total_parts_ordered + 1 ELSE total_parts_received END AS total_parts_received,
  CASE WHEN (CAST(substr(supplier_id, 4) AS BIGINT) + CAST(substr(metric_month, 6, 2) AS BIGINT)) % 17 = 0
       THEN total_spend * 1.05 ELSE total_spend END AS total_spend,
  CASE WHEN (CAST(substr(supplier_id, 4) AS BIGINT) + CAST(substr(metric_month, 6, 2) AS BIGINT)) % 19 = 0
       THEN defect_count + 1
       WHEN (CAST(substr(supplier_id, 4) AS BIGINT) + CAST(substr(metric_month, 6, 2) AS BIGINT)) % 43 = 0
       THEN -1 ELSE defect_count END AS defect_count,
  CASE WHEN (CAST(substr(supplier_id, 4) AS BIGINT) + CAST(substr(metric_month, 6, 2) AS BIGINT)) % 29 = 0
       THEN defect_rate_pct + 150.0 ELSE defect_rate_pct END AS defect_rate_pct,
  on_time_delivery_count, on_time_delivery_pct, avg_lead_time_days, quality_score, dq_load_date
FROM {gold}
WHERE NOT (substr(metric_month, 6, 2) = '07' AND CAST(substr(metric_month, 1, 4) AS BIGINT) % 2 = 1)
  AND CAST(substr(supplier_id, 4) AS BIGINT) % 29 <> 5
"""

# One run record per event: layer, outcome and a multi-line failure log picked
# by the event id.  Feeds the triage operators.
RUNS_SQL = """
SELECT
  event_id AS run_id,
  'tests/' || CASE event_id % 5 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' WHEN 2 THEN 'gold'
                                WHEN 3 THEN 'integration' ELSE 'sql' END
    || '/test_' || event_type || '.py::test_' || CAST(event_id AS STRING) AS node_id,
  CASE WHEN event_id % 3 = 0 THEN ''
       ELSE CASE event_id % 5 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' WHEN 2 THEN 'gold'
                              WHEN 3 THEN 'integration' ELSE 'sql' END || ',' || event_type END AS keywords,
  CASE WHEN event_type IN ('error', 'signup') THEN 'failed' ELSE 'passed' END AS outcome,
  CASE WHEN event_type NOT IN ('error', 'signup') THEN ''
       WHEN event_id % 7 = 0 THEN 'def test_check():' || chr(10) || '>       assert result.passed' || chr(10)
            || 'E       AssertionError: ' || CAST(event_id % 13 AS STRING) || ' rows failed' || chr(10) || chr(10)
            || 'tests/check.py:42: AssertionError'
       WHEN event_id % 7 = 1 THEN 'E   ModuleNotFoundError: No module named ''yaml_loader'''
       WHEN event_id % 7 = 2 THEN 'Traceback (most recent call last):' || chr(10)
            || '  File "loader.py", line 47' || chr(10) || 'FileNotFoundError: [Errno 2] No such file: data.csv'
       WHEN event_id % 7 = 3 THEN 'query failed' || chr(10) || 'duckdb.BinderException: Binder Error: column not found'
       WHEN event_id % 7 = 4 THEN '    value = row[key]' || chr(10) || 'E   KeyError: ''supplier_id'''
       WHEN event_id % 7 = 5 THEN 'something went wrong' || chr(10) || 'ZeroDivisionError: division by zero' || chr(10) || '   '
       ELSE 'E   TypeError: unsupported operand' || chr(10) || 'E   ValueError: bad value' END AS longrepr,
  value AS duration
FROM {events}
"""


def bind_duckdb(sql: str, **names: str) -> str:
    """Fill ``{name}`` placeholders with table / CTE names for DuckDB."""
    return sql.format(**names)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BRONZE_SUPPLIERS_SQL, supplier=_read(spark, sf_dir, "supplier"), nation=_read(spark, sf_dir, "nation"))


def bronze_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BRONZE_PARTS_SQL, part=_read(spark, sf_dir, "part"), supplier=_read(spark, sf_dir, "supplier"))


def bronze_work_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # No hand-placed repartition: the join's own shuffle is the one AQE can
    # split when an order key is skewed (or drop, when orders fits a broadcast).
    return spark.sql(BRONZE_WORK_ORDERS_SQL, lineitem=_read(spark, sf_dir, "lineitem"), orders=_read(spark, sf_dir, "orders"))


def gold_with_drift(spark: SparkSession, gold: DataFrame) -> DataFrame:
    return spark.sql(GOLD_DRIFT_SQL, gold=gold)


def test_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RUNS_SQL, events=_read(spark, sf_dir, "events"))
