"""Report queries of the bronze / silver / gold gates.

Each is one lazy DataFrame over the reference-shaped tables (suppliers, parts,
work_orders, production_metrics).  Multi-branch reports read each table once:
per-column null profiles are one aggregate unpivoted, rule lists are one scan
exploded, orphan reports are anti joins.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import count_if
from ..functions.text import iso_date, strip_ws
from ..sources.fixtures import PAYMENT_TERMS
from ._common import flag_rows
from .consistency import as_of_ts
from .transform import CLOSED_STATES, month_of, silver_aggregate

# Status and remediation texts of the reference's report queries.
FAIL_CRITICAL_NULLS = "FAIL — Critical column has NULLs"
FAIL_EMAIL_RATE = "FAIL — Email null rate exceeds 10% threshold"
WARN_NULLS = "WARN — NULLs detected (review)"
FAIL_PK_NULL = "FAIL — PK cannot be NULL"
FAIL_OVER_5 = "FAIL — Exceeds 5% null threshold"
WARN_REVIEW = "WARN — Review nulls"
RECON_SPEND = "FAIL — spend variance > 1%"
RECON_DEFECT = "FAIL — defect count mismatch"
RECON_ORDERS = "FAIL — order count mismatch"
RECON_NO_SILVER = "WARN — no Silver orders for this month/supplier"
REMEDIATION_PARTS = "Supplier not found in silver_suppliers — part must be excluded or supplier onboarded"
REMEDIATION_ORDERS = "Part not found in silver_parts — investigate source system referential integrity"
REMEDIATION_GOLD = "Supplier in Gold not found in Silver — Gold aggregation may include decommissioned suppliers"
# Statuses of a reconciled row by rank: the first that applies holds.
RECON_LADDER = [RECON_SPEND, RECON_DEFECT, RECON_ORDERS, RECON_NO_SILVER, "PASS"]
RATE_MISMATCH = "FAIL — computed vs stored defect_rate mismatch"
# (label, measure, least, most) of the bounded KPIs; (label, smaller, larger) of the ordered ones.
KPI_LIMITS = [("defect_rate_pct", "defect_rate_pct", 0, 100), ("on_time_pct", "on_time_delivery_pct", 0, 100), ("quality_score", "quality_score", 1, 5),
              ("total_spend", "total_spend", 0, None), ("avg_lead_time", "avg_lead_time_days", 0, None)]
KPI_ORDERS = [("received>ordered", "total_parts_received", "total_parts_ordered"), ("defects>received", "defect_count", "total_parts_received")]
# (alert, measure, sign, warning bound, critical bound, warning text, critical text): sign * measure beyond sign * bound;
# {} in a text is the measure.
ALERT_BANDS = [
    ("defect_alert", "defect_rate_pct", 1, 10, 20, "WARNING — defect rate >{}% (threshold: 10%)", "CRITICAL — defect rate >{}% (threshold: 20%)"),
    ("otd_alert", "on_time_delivery_pct", -1, 85, 70, "WARNING — OTD <85% (threshold: 85%)", "CRITICAL — OTD <70% (threshold: 70%)"),
    ("quality_alert", "quality_score", -1, 3.5, 3.0, "WARNING — quality score <3.5", "CRITICAL — quality score <3.0 — supplier review required"),
]


# ---------------------------------------------------------------------------
# Bronze: null profiles, padding, formats, numeric ranges
# ---------------------------------------------------------------------------

def null_profile(
    df: DataFrame,
    table_name: str,
    columns: Sequence[tuple[str, bool]],
    status: Callable[[Column, Column, Column], Column],
) -> DataFrame:
    """Per-column null (or null-or-blank) counts from ONE aggregate, unpivoted.

    ``columns`` holds (name, blank_counts_as_null).  ``status(name, nulls,
    total)`` builds the ladder.  Columns: table_name, column_name, total_rows,
    null_count, null_rate_pct (2 dp), dq_status.
    """
    def missing(c, blank):
        col = F.col(c)
        return col.isNull() | (F.trim(col.cast("string")) == "") if blank else col.isNull()

    one = df.agg(F.count(F.lit(1)).alias("total_rows"), *[count_if(missing(c, b)).alias(f"__n{i}") for i, (c, b) in enumerate(columns)])
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__n{i}").alias("null_count")) for i, (c, _) in enumerate(columns)])
    rows = one.select("total_rows", F.explode(arr).alias("__c")).select(
        F.lit(table_name).alias("table_name"), "__c.column_name", "total_rows",
        F.coalesce(F.col("__c.null_count"), F.lit(0)).cast("bigint").alias("null_count"),
    )
    n, t = F.col("null_count"), F.col("total_rows")
    return rows.select(
        "table_name", "column_name", "total_rows", "null_count",
        F.when(t > 0, F.round(n * 100.0 / t, 2)).alias("null_rate_pct"),
        status(F.col("column_name"), n, t).alias("dq_status"),
    )


def null_profile_suppliers(df: DataFrame, table_name: str = "bronze.suppliers_raw") -> DataFrame:
    cols = [("supplier_id", False), ("supplier_name", True), ("email", True), ("country", True),
            ("contract_start_date", True), ("quality_rating", False)]

    def status(name, n, t):
        return (F.when(name.isin("supplier_id", "supplier_name", "status") & (n > 0), F.lit(FAIL_CRITICAL_NULLS))
                .when((name == "email") & (F.try_divide(n * 100.0, t) > 10), F.lit(FAIL_EMAIL_RATE))
                .when(n > 0, F.lit(WARN_NULLS)).otherwise(F.lit("PASS")))
    return null_profile(df, table_name, cols, status)


def null_profile_parts(df: DataFrame, table_name: str = "bronze.parts_catalog_raw") -> DataFrame:
    cols = [("part_id", False), ("part_number", True), ("part_name", True), ("supplier_id", False),
            ("unit_price", False), ("part_category", True)]

    def status(name, n, t):
        return (F.when((name == "part_id") & (n > 0), F.lit(FAIL_PK_NULL))
                .when(F.try_divide(n * 100.0, t) > 5, F.lit(FAIL_OVER_5))
                .when(n > 0, F.lit(WARN_REVIEW)).otherwise(F.lit("PASS")))
    return null_profile(df, table_name, cols, status)


def whitespace_report(df: DataFrame, key: str = "supplier_id", column: str = "supplier_name") -> DataFrame:
    """Padded values with raw and stripped lengths (strict: trailing-only padding counts)."""
    c = F.col(column)
    return df.filter(c.isNotNull() & (F.length(c) != F.length(strip_ws(c)))).select(
        key, column, F.length(c).cast("bigint").alias("raw_length"), F.length(strip_ws(c)).cast("bigint").alias("trimmed_length"),
        F.lit("Leading/trailing whitespace").alias("issue"),
    )


def date_format_diagnosis(df: DataFrame, key: str = "supplier_id", name: str = "supplier_name",
                          column: str = "contract_start_date") -> DataFrame:
    c = F.col(column)
    parsed = iso_date(c)
    diag = (F.when(c.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), F.lit("DD/MM/YYYY — needs conversion"))
            .when(c.rlike(r"^[0-9]{2}-[0-9]{2}-[0-9]{4}$"), F.lit("DD-MM-YYYY — needs conversion"))
            .when(c.rlike(r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$"), F.lit("YYYY/MM/DD — needs conversion"))
            .when(parsed.isNull(), F.lit("UNPARSEABLE — manual review required"))
            .otherwise(F.lit("ISO 8601 YYYY-MM-DD — OK")))
    return df.filter(c.isNotNull()).select(
        key, name, column, diag.alias("date_format_diagnosis"),
        F.when(parsed.isNull(), F.lit("FAIL")).otherwise(F.lit("PASS")).alias("dq_status"),
    )


def email_diagnosis(df: DataFrame, key: str = "supplier_id", name: str = "supplier_name", column: str = "email") -> DataFrame:
    c = F.col(column)
    status = (F.when(c.isNull(), F.lit("NULL — remediation required"))
              .when(~c.like("%@%.%"), F.lit("FAIL — invalid email format"))
              .when(c.like("% %"), F.lit("FAIL — contains spaces"))
              .otherwise(F.lit("PASS")))
    return df.select(key, name, column, status.alias("email_dq_status"))


def numeric_range_report(suppliers: DataFrame, parts: DataFrame) -> DataFrame:
    """Rating, price and lead-time violations in one (check_name, id, name, value, issue) table."""
    rating = suppliers.select(
        "supplier_id", "supplier_name", F.col("quality_rating").cast("string").try_cast("double").alias("__r"), "quality_rating"
    ).filter((F.col("__r") < 1.0) | (F.col("__r") > 5.0)).select(
        F.lit("quality_rating out of range").alias("check_name"), F.col("supplier_id").alias("entity_id"),
        F.col("supplier_name").alias("entity_name"), F.col("quality_rating").cast("string").alias("value"),
        F.lit("FAIL — must be between 1.0 and 5.0").alias("issue"))
    flags = [
        ("unit_price non-positive", F.col("unit_price") <= 0, F.col("unit_price")),
        ("lead_time_days out of range", (F.col("lead_time_days") < 1) | (F.col("lead_time_days") > 365), F.col("lead_time_days")),
    ]
    issue = F.when(F.col("check_name") == "unit_price non-positive", F.lit("FAIL — price must be > 0")).otherwise(
        F.lit("FAIL — lead time must be 1-365 days"))
    pr = flag_rows(parts.select("part_id", "part_name", "unit_price", "lead_time_days"), ["part_id", "part_name"], flags,
                   names=("check_name", "value")).select(
        "check_name", F.col("part_id").alias("entity_id"), F.col("part_name").alias("entity_name"), "value", issue.alias("issue"))
    return rating.unionByName(pr)


# ---------------------------------------------------------------------------
# Silver: orphans, business rules
# ---------------------------------------------------------------------------

def _anti(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose key is missing from the parent (null keys included), skew-safe."""
    from .skew import missing

    return missing(child, fk, parent, pk)


def orphans_parts_suppliers(parts: DataFrame, suppliers: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Parts whose (non-null) supplier is missing from suppliers, with the ``extra`` columns of the part."""
    o = _anti(parts.filter(F.col("supplier_id").isNotNull()), "supplier_id", suppliers, "supplier_id")
    return o.select(F.lit("silver_parts → silver_suppliers").alias("relationship"), "part_id", "part_number", "part_name",
                    F.col("supplier_id").alias("orphaned_supplier_id"), F.lit(REMEDIATION_PARTS).alias("remediation"), *extra)


def orphans_orders_parts(work_orders: DataFrame, parts: DataFrame) -> DataFrame:
    """Work orders whose part is missing; a null part counts as an orphan."""
    o = _anti(work_orders, "part_id", parts, "part_id")
    return o.select(F.lit("silver_work_orders → silver_parts").alias("relationship"), "work_order_id",
                    F.col("part_id").alias("orphaned_part_id"), "status", "total_cost",
                    F.lit(REMEDIATION_ORDERS).alias("remediation"))


def orphans_gold_suppliers(gold: DataFrame, suppliers: DataFrame) -> DataFrame:
    o = _anti(gold, "supplier_id", suppliers, "supplier_id")
    return o.select(F.lit("gold_metrics → silver_suppliers").alias("relationship"), "metric_month",
                    F.col("supplier_id").alias("orphaned_supplier_id"), "supplier_name", "total_spend",
                    F.lit(REMEDIATION_GOLD).alias("remediation"))


def orphan_summary(parts: DataFrame, suppliers: DataFrame, work_orders: DataFrame, gold: DataFrame,
                   parent_parts: DataFrame | None = None) -> DataFrame:
    """One row per relationship with its orphan count (``parent_parts``: the
    parts work orders must reference, default ``parts``).  Children are reduced
    to rows per key first, so a hot key is one row a task."""
    def n(child, fk, parent, label, nulls):
        per_key = child.groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
        per_key = per_key if nulls else per_key.filter(F.col(fk).isNotNull())
        return _anti(per_key, fk, parent, fk).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphaned_count")).select(
            F.lit(label).alias("fk_relationship"), "orphaned_count")
    return (n(parts, "supplier_id", suppliers, "parts → suppliers", False)
            .unionByName(n(work_orders, "part_id", parent_parts if parent_parts is not None else parts, "work_orders → parts", True))
            .unionByName(n(gold, "supplier_id", suppliers, "gold_metrics → suppliers", True)))


def evaluate_rules(df: DataFrame, key_cols: Sequence[str], rules: Sequence[tuple[str, Column, Column, Column]]) -> DataFrame:
    """Rule list → violation rows in one scan.

    ``rules`` holds (rule name, violation condition, column_value, detail).
    Columns: business_rule, keys..., column_value, violation_detail.
    """
    arr = F.array(*[
        F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(name).alias("business_rule"), value.cast("string").alias("column_value"),
                                                         detail.cast("string").alias("violation_detail")))
        for name, cond, value, detail in rules
    ])
    out = df.select(*key_cols, F.explode(arr).alias("__r")).filter(F.col("__r").isNotNull())
    return out.select("__r.business_rule", *key_cols, "__r.column_value", "__r.violation_detail")


def rules_suppliers(suppliers: DataFrame, as_of=None) -> DataFrame:
    r = F.col("quality_rating").cast("string").try_cast("double")
    terms = F.col("payment_terms")
    today = F.to_date(as_of_ts(as_of))
    start = F.col("contract_start_date").cast("string").try_cast("date")
    rules = [
        ("BR-SUP-001: quality_rating range", (r < 1.0) | (r > 5.0), F.col("quality_rating"),
         F.lit("FAIL — must be 1.0 ≤ rating ≤ 5.0")),
        ("BR-SUP-002: payment_terms accepted values", ~terms.isin(*PAYMENT_TERMS), terms,
         F.concat(F.lit("FAIL — "), F.coalesce(terms, F.lit("NULL")), F.lit(" is not an approved payment term"))),
        ("BR-SUP-003: contract_start_date not future", start > today, F.col("contract_start_date"),
         F.concat(F.lit("FAIL — contract date is in the future: "), F.col("contract_start_date").cast("string"))),
    ]
    return evaluate_rules(suppliers, ["supplier_id", "supplier_name"], rules)


def rules_parts(parts: DataFrame) -> DataFrame:
    rules = [
        ("BR-PART-001: unit_price positive", F.col("unit_price") <= 0, F.col("unit_price"), F.lit("FAIL — unit_price must be > 0")),
        ("BR-PART-002: lead_time_days valid range", (F.col("lead_time_days") < 1) | (F.col("lead_time_days") > 365),
         F.col("lead_time_days"), F.lit("FAIL — lead_time must be 1 ≤ days ≤ 365")),
        ("BR-PART-003: is_critical populated", F.col("is_critical").isNull(), F.col("is_critical"),
         F.lit("FAIL — is_critical cannot be NULL for any part")),
    ]
    return evaluate_rules(parts, ["part_id", "part_name"], rules)


def rules_work_orders(work_orders: DataFrame) -> DataFrame:
    rules = [
        ("BR-WO-001: received ≤ ordered", F.col("quantity_received") > F.col("quantity_ordered"),
         F.concat(F.col("quantity_ordered").cast("string"), F.lit(" ordered, "), F.col("quantity_received").cast("string"), F.lit(" received")),
         F.lit("FAIL — cannot receive more than ordered")),
        ("BR-WO-002: CLOSED orders must have actual_delivery", (F.col("status") == "CLOSED") & F.col("actual_delivery").isNull(),
         F.col("actual_delivery"), F.lit("FAIL — CLOSED work orders must have an actual_delivery date")),
    ]
    return evaluate_rules(work_orders, ["work_order_id", "part_id"], rules)


def unexplained_critical_drops(bronze_parts: DataFrame, silver_parts: DataFrame) -> DataFrame:
    """Critical bronze parts missing from silver, excluding the documented causes
    (non-positive price, null supplier)."""
    from .skew import keep_matching

    crit = bronze_parts.filter((F.col("is_critical") == F.lit(True)) & (F.col("unit_price").cast("double") > 0)
                               & F.col("supplier_id").isNotNull())
    return keep_matching(crit, "part_id", silver_parts, "part_id", keep=False).select("part_id", "unit_price", "supplier_id")


# ---------------------------------------------------------------------------
# Gold: reconciliation, KPI bounds, rate math, alerts, continuity
# ---------------------------------------------------------------------------

def gold_reconciliation(gold: DataFrame, work_orders: DataFrame, parts: DataFrame, spend_tolerance: float = 0.01) -> DataFrame:
    """Gold month × supplier rows against the silver aggregate, with a
    first-match status ladder and its rank (sort key)."""
    s = silver_aggregate(work_orders, parts).select(
        F.col("metric_month").alias("s_month"), F.col("supplier_id").alias("s_supplier"),
        "silver_total_spend", "silver_defect_count", "silver_order_count")
    g = gold.select("metric_month", "supplier_id", F.col("total_spend").alias("gold_total_spend"),
                    F.col("defect_count").alias("gold_defect_count"), F.col("total_orders").alias("gold_order_count"))
    j = g.join(s, (g["metric_month"] == s["s_month"]) & (g["supplier_id"] == s["s_supplier"]), "left")
    ss = F.coalesce(F.col("silver_total_spend"), F.lit(0.0))
    var = F.abs(F.col("gold_total_spend") - ss)
    off = [var > ss * spend_tolerance, F.col("gold_defect_count") != F.coalesce(F.col("silver_defect_count"), F.lit(0)),
           F.col("gold_order_count") != F.coalesce(F.col("silver_order_count"), F.lit(0)), F.col("s_month").isNull()]
    rank = F.array_position(F.array(*[F.coalesce(c, F.lit(False)) for c in off], F.lit(True)), True).cast("int")
    return j.select(
        "metric_month", "supplier_id", "gold_total_spend", ss.alias("silver_total_spend"), var.alias("spend_abs_var"),
        F.when(ss == 0, F.lit(None)).otherwise(F.round(var / ss * 100, 4)).alias("spend_var_pct"),
        "gold_defect_count", F.coalesce(F.col("silver_defect_count"), F.lit(0)).cast("bigint").alias("silver_defect_count"),
        "gold_order_count", F.coalesce(F.col("silver_order_count"), F.lit(0)).cast("bigint").alias("silver_order_count"),
        rank.alias("status_rank"),
    ).withColumn("reconciliation_status", F.element_at(F.array(*map(F.lit, RECON_LADDER)), F.col("status_rank")))


def singular_gold_reconciliation(gold: DataFrame, work_orders: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows with spend variance > 1% and positive silver spend (severity warn)."""
    r = gold_reconciliation(gold, work_orders, parts)
    return r.filter((F.col("spend_abs_var") > F.col("silver_total_spend") * 0.01) & (F.col("silver_total_spend") > 0)).select(
        "metric_month", "supplier_id", "gold_total_spend", "silver_total_spend",
        F.col("spend_abs_var").alias("abs_variance"), F.col("spend_var_pct").alias("variance_pct"))


def kpi_violations(gold: DataFrame) -> DataFrame:
    """Rows that break a KPI limit or order, with the broken ones as text and their count."""
    said = []
    for label, measure, least, most in KPI_LIMITS:
        x = F.col(measure)
        outside = (x < least) | (x > most) if most is not None else x < least
        said.append(F.when(outside, F.concat(F.lit(f"{label}="), x.cast("string"), F.lit(" "))))
    said += [F.when(F.col(small) > F.col(large), F.lit(f"{label} ")) for label, small, large in KPI_ORDERS]
    broken = gold.select("metric_month", "supplier_id", "supplier_name", F.array_compact(F.array(*said)).alias("said")).filter(F.size("said") > 0)
    return broken.select("metric_month", "supplier_id", "supplier_name", F.array_join("said", "").alias("violations"), F.size("said").alias("violation_count"))


def defect_rate_math(gold: DataFrame, tolerance: float = 0.1) -> DataFrame:
    computed = F.when(F.col("total_parts_received") > 0,
                      F.col("defect_count").cast("double") * 100.0 / F.col("total_parts_received").cast("double")).otherwise(F.lit(0.0))
    disc = F.abs(F.col("defect_rate_pct") - computed)
    return gold.filter(F.col("total_parts_received") > 0).select(
        "metric_month", "supplier_id", "supplier_name", "defect_count", "total_parts_received",
        F.col("defect_rate_pct").alias("stored_defect_rate_pct"), F.round(computed, 2).alias("computed_defect_rate_pct"),
        disc.alias("rate_discrepancy"),
        F.when(disc > tolerance, F.lit(RATE_MISMATCH)).otherwise(F.lit("PASS")).alias("dq_status"),
    )


def supplier_alerts(gold: DataFrame) -> DataFrame:
    """Rows with a measure in a warning or critical band, and the text of each measure's band."""
    def level(measure, sign, *bounds):
        x = F.col(measure) * sign
        return sum((F.coalesce((x > sign * b).cast("int"), F.lit(0)) for b in bounds), F.lit(0))

    def text(measure, template):
        before, mark, after = template.partition("{}")
        return F.concat(F.lit(before), F.col(measure).cast("string"), F.lit(after)) if mark else F.lit(template)

    levels = {name: level(measure, sign, warn, crit) for name, measure, sign, warn, crit, *_ in ALERT_BANDS}
    out = [F.element_at(F.array(F.lit("OK"), text(measure, warn), text(measure, crit)), levels[name] + 1).alias(name)
           for name, measure, _, _, _, warn, crit in ALERT_BANDS]
    return gold.filter(sum(levels.values(), F.lit(0)) > 0).select(
        "metric_month", "supplier_id", "supplier_name", "defect_rate_pct", "on_time_delivery_pct", "quality_score", "total_spend", *out)


def kpi_bounds(gold: DataFrame) -> DataFrame:
    """Demo gate: defect rate outside 0–100, quality outside 1–5, negative spend (NOT BETWEEN)."""
    d, q, s = (F.col(c).cast("double") for c in ("defect_rate_pct", "quality_score", "total_spend"))
    return gold.filter(~d.between(0, 100) | ~q.between(1, 5) | (s < 0)).select(
        "metric_month", "supplier_id", "defect_rate_pct", "quality_score", "total_spend")


def top_spend_variance(gold: DataFrame, work_orders: DataFrame, parts: DataFrame, k: int = 5) -> DataFrame:
    """Top-k (month, supplier) by spend variance % among matched rows with positive
    silver spend.  Ties broken by key so the top-k is deterministic."""
    s = silver_aggregate(work_orders, parts).select("metric_month", "supplier_id", F.col("silver_total_spend").alias("silver_total"))
    g = gold.groupBy("metric_month", "supplier_id").agg(
        F.sum(F.col("total_spend").cast("decimal(18,2)")).cast("double").alias("gold_total"))
    j = g.join(s, ["metric_month", "supplier_id"], "inner").filter(F.col("silver_total") > 0)
    var = F.round(F.try_divide(F.abs(F.col("silver_total") - F.col("gold_total")), F.col("silver_total")) * 100, 1)
    return j.select("metric_month", "supplier_id", F.round("silver_total", 2).alias("silver_total"),
                    F.round("gold_total", 2).alias("gold_total"), var.alias("variance_pct")).orderBy(
        F.col("variance_pct").desc(), "metric_month", "supplier_id").limit(k)


def scoped_sum_reconcile(work_orders: DataFrame, parts: DataFrame, gold: DataFrame, tolerance_pct: float = 10.0) -> DataFrame:
    """Silver CLOSED/PARTIAL spend restricted to gold's months and suppliers vs
    gold total spend.  One row: silver_total, gold_total, diff_pct, passed."""
    wo = work_orders.filter(F.col("status").isin(*CLOSED_STATES)).select(
        "part_id", month_of("order_date").alias("metric_month"), "total_cost")
    from .skew import keep_matching

    sw = wo.join(parts.select("part_id", "supplier_id"), "part_id", "inner").withColumn(
        "__sup_text", F.col("supplier_id").cast("string"))
    months = gold.select(F.col("metric_month").cast("string").alias("metric_month"))
    sups = gold.select(F.col("supplier_id").cast("string").alias("supplier_id"))
    # totals per month and supplier first: the semi joins see one row for each
    sw = sw.groupBy("metric_month", "__sup_text").agg(F.sum(F.col("total_cost").cast("decimal(18,2)")).alias("total_cost"))
    scoped = keep_matching(keep_matching(sw, "metric_month", months, "metric_month"), "__sup_text", sups, "supplier_id")
    gsum = gold.agg(F.sum(F.col("total_spend").cast("decimal(18,2)")).cast("double")).scalar()
    both = scoped.agg(F.coalesce(F.sum("total_cost").cast("double"), F.lit(0.0)).alias("silver_total")).select(
        "silver_total", gsum.alias("gold_total"))
    diff = F.when(F.col("silver_total") > 0, F.abs(F.col("silver_total") - F.col("gold_total")) / F.col("silver_total") * 100)
    return both.select("silver_total", "gold_total", F.round(diff, 4).alias("diff_pct"),
                       F.coalesce(diff <= tolerance_pct, F.lit(True)).alias("passed"))


def coverage(work_orders: DataFrame, parts: DataFrame, gold: DataFrame) -> DataFrame:
    """Suppliers with CLOSED/PARTIAL orders in gold's months that gold lacks."""
    from .skew import keep_matching

    wo = work_orders.filter(F.col("status").isin(*CLOSED_STATES)).select("part_id", month_of("order_date").alias("metric_month"))
    sold = wo.join(parts.select("part_id", "supplier_id"), "part_id", "inner").select(
        "metric_month", F.col("supplier_id").cast("string").alias("supplier_id")).dropna().distinct()
    expected = keep_matching(sold, "metric_month", gold, "metric_month").select("supplier_id").distinct()
    present = gold.select(F.col("supplier_id").cast("string").alias("supplier_id")).distinct()
    return expected.join(present, "supplier_id", "left_anti")


def month_continuity(gold: DataFrame, column: str = "metric_month") -> DataFrame:
    """Gaps of more than one month between consecutive distinct months.

    The window runs over the distinct month set only — its size is bounded by
    the calendar span of the table (12 rows a year), not by the row count.
    """
    from pyspark.sql import Window

    m = gold.select(F.to_date(F.col(column).cast("string"), "yyyy-MM").alias("m")).dropna().distinct()
    w = Window.orderBy("m")
    prev = F.lag("m").over(w)
    gaps = m.select(prev.alias("prev"), F.col("m")).filter(F.col("prev").isNotNull())
    months = (F.year("m") - F.year("prev")) * 12 + (F.month("m") - F.month("prev"))
    return gaps.filter(months > 1).select(F.date_format("prev", "yyyy-MM").alias("gap_after"),
                                          F.date_format("m", "yyyy-MM").alias("gap_before"), months.cast("bigint").alias("months_apart"))
