"""Layer transforms: promote bronze → silver (with quarantine), build gold KPIs.

The reference ships no cleansing or gold-building code; its silver and gold
files imply three actions which are expressed here as one lazy plan per table:
*normalise* (trim, DD/MM/YYYY → ISO), *correct* (fill from a corrections table
or a default expression), *reject* (first failing rule of a ladder, or an
orphan foreign key against the promoted parent).  Rejected rows go to a
quarantine DataFrame with a reason; promoted + quarantined = input.
"""
from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import iso_date, is_null_or_blank, strip_ws, to_number
from ..sources.fixtures import PAYMENT_TERMS, SUPPLIER_STATUSES, WORK_ORDER_STATUSES
from ._common import written
from .skew import mark_membership, split_by

DEFAULT_AS_OF = "2025-01-01"


@dataclass
class Promotion:
    promoted: DataFrame
    quarantine: DataFrame
    flagged: DataFrame | None = None  # every row + reject_reason (null = promoted) + stamp

    @staticmethod
    def split(flagged: DataFrame) -> "Promotion":
        """Promoted / quarantined views of one flagged table (two filters, one source)."""
        cols = [c for c in flagged.columns if c not in ("reject_reason", "dq_load_date")]
        return Promotion(
            flagged.filter(F.col("reject_reason").isNull()).select(*cols, "dq_load_date"),
            flagged.filter(F.col("reject_reason").isNotNull()).select(*cols, "reject_reason", "dq_load_date"),
            flagged,
        )


@dataclass
class PromoteSpec:
    key: str
    normalise: dict[str, Column] = field(default_factory=dict)
    fills: dict[str, Column] = field(default_factory=dict)
    # (reason, condition that marks the row as bad), evaluated in order
    reject: list[tuple[str, Column]] = field(default_factory=list)
    # (fk column, promoted parent DataFrame, parent key column, reason)
    parents: list[tuple[str, DataFrame, str, str]] = field(default_factory=list)
    casts: dict[str, str] = field(default_factory=dict)


def _as_of_date(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.lit(str(as_of)).cast("date")


def apply_corrections(df: DataFrame, corrections: DataFrame | None, key: str) -> DataFrame:
    """Overwrite nulls in ``df`` with values from a curated corrections table
    (``key`` + any subset of columns).  Of several corrections of a key, the
    least non-null value of each column holds."""
    if corrections is None:
        return df
    cols = [c for c in corrections.columns if c != key and c in df.columns]
    if not cols:
        return df
    corr = corrections.groupBy(key).agg(*[F.min(c).alias(f"__corr_{c}") for c in cols])
    joined = df.join(corr, on=key, how="left")
    return joined.select(
        *[F.coalesce(F.col(c), F.col(f"__corr_{c}")).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def promote(df: DataFrame, spec: PromoteSpec, as_of=DEFAULT_AS_OF, corrections: DataFrame | None = None) -> Promotion:
    """Normalise → correct → reject ladder → orphan check against each promoted
    parent → one row per key → stamp.  The input is read once: few projections
    (each ``withColumns`` is one Project) and a left join per parent, whose keys
    are unique by this same contract, then written.  Repeated keys are settled on
    what is written (``_one_row_a_key``); promoted and quarantined rows are two
    filters over it."""
    out = apply_corrections(df, corrections, spec.key)
    if spec.normalise:
        out = out.withColumns(spec.normalise)
    fix = {name: F.coalesce(F.col(name), expr) for name, expr in spec.fills.items()}
    fix.update({name: F.col(name).cast("string").try_cast(typ) if typ != "string" else F.col(name).cast(typ)
                for name, typ in spec.casts.items()})
    if fix:
        out = out.withColumns(fix)
    reason = F.lit(None).cast("string")
    for label, bad in reversed(spec.reject):
        reason = F.when(F.coalesce(bad, F.lit(False)), F.lit(label)).otherwise(reason)
    base_cols = list(out.columns)
    out = out.withColumn("reject_reason", reason)
    for i, (fk, parent, pk, label) in enumerate(spec.parents):
        hit = f"__hit{i}"
        out = mark_membership(out, fk, parent, pk, flag=hit, unique=True)
        orphan = F.col("reject_reason").isNull() & F.col(fk).isNotNull() & F.col(hit).isNull()
        out = out.select(*base_cols, F.when(orphan, F.lit(label)).otherwise(F.col("reject_reason")).alias("reject_reason"))
    staged = written(out.withColumn("__row", F.monotonically_increasing_id()), "staged")
    flagged = _one_row_a_key(staged, spec.key, base_cols)
    return Promotion.split(flagged.select(*base_cols, "reject_reason", _as_of_date(as_of).alias("dq_load_date")))


def _one_row_a_key(staged: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Of the accepted rows of a key, the first in column order (nulls first) stays; the others become ``duplicate_key``.

    Only keys that repeat are looked at: their counts are combined before the shuffle, and so is the least row of each
    (one row a task, however often a key occurs); nothing is sorted by row.  Rejected rows and rows whose key surely
    does not repeat are not shuffled (``split_by``).  Equal rows are told apart by ``__row``, which is fixed because
    *staged* is a written table.  Both small tables are written, so the joins are plain."""
    kept = F.col("reject_reason").isNull()
    repeated = written(staged.where(kept).groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(key), "repeated-keys")
    if repeated.isEmpty():
        return staged
    may, single = split_by(staged.withColumn("__kept_key", F.when(kept, F.col(key))), "__kept_key", repeated, key)
    least = may.where(kept).join(repeated, key, "left_semi").groupBy(key).agg(F.min(F.struct(*columns, "__row")).alias("__least"))
    first = written(least.select(F.col(key).alias("__key"), F.col("__least.__row").alias("__first")), "first-rows")
    out = may.join(first, may[key] == first["__key"], "left")
    later = kept & (F.col("__first") != F.col("__row"))  # null, so no, where the key does not repeat
    out = out.select(*columns, F.when(later, F.lit("duplicate_key")).otherwise(F.col("reject_reason")).alias("reject_reason"))
    return out.union(single.select(*columns, "reject_reason"))


# ---------------------------------------------------------------------------
# Reference-shaped promotions
# ---------------------------------------------------------------------------

_DMY = r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"


def dmy_to_iso(col: str) -> Column:
    c = F.col(col)
    return F.when(
        c.rlike(_DMY), F.concat(F.substring(c, 7, 4), F.lit("-"), F.substring(c, 4, 2), F.lit("-"), F.substring(c, 1, 2))
    ).otherwise(c)


def supplier_spec() -> PromoteSpec:
    return PromoteSpec(
        key="supplier_id",
        normalise={"supplier_name": strip_ws("supplier_name"), "contract_start_date": dmy_to_iso("contract_start_date")},
        fills={"email": F.concat(F.lit("unknown+"), F.lower(F.col("supplier_id")), F.lit("@example.com"))},
        casts={"quality_rating": "double"},
        reject=[
            ("missing_key", F.col("supplier_id").isNull()),
            ("invalid_status", ~F.coalesce(F.col("status").isin(*SUPPLIER_STATUSES), F.lit(False))),
            ("invalid_contract_date", iso_date("contract_start_date").isNull()),
            ("invalid_quality_rating", F.col("quality_rating").isNull()),
            ("invalid_payment_terms", ~F.coalesce(F.col("payment_terms").isin(*PAYMENT_TERMS), F.lit(False))),
            ("missing_name", is_null_or_blank("supplier_name")),
        ],
    )


def promote_suppliers(bronze: DataFrame, as_of=DEFAULT_AS_OF, corrections: DataFrame | None = None) -> Promotion:
    return promote(bronze, supplier_spec(), as_of, corrections)


def parts_spec(silver_suppliers: DataFrame) -> PromoteSpec:
    name = strip_ws("part_name")
    return PromoteSpec(
        key="part_id",
        normalise={"part_name": F.when(name == "", F.lit(None)).otherwise(name)},
        fills={"part_name": F.col("part_number")},
        reject=[
            ("missing_key", F.col("part_id").isNull()),
            ("non_positive_price", F.coalesce(to_number("unit_price") <= 0, F.lit(True))),
            ("missing_supplier", F.col("supplier_id").isNull()),
        ],
        parents=[("supplier_id", silver_suppliers, "supplier_id", "orphan_supplier")],
    )


def promote_parts(bronze: DataFrame, silver_suppliers: DataFrame, as_of=DEFAULT_AS_OF, corrections=None) -> Promotion:
    return promote(bronze, parts_spec(silver_suppliers), as_of, corrections)


def work_orders_spec(silver_parts: DataFrame) -> PromoteSpec:
    return PromoteSpec(
        key="work_order_id",
        normalise={
            "actual_delivery": F.when(
                (F.col("status") == "CLOSED") & F.col("actual_delivery").isNull(), F.col("expected_delivery")
            ).otherwise(F.col("actual_delivery"))
        },
        reject=[
            ("missing_key", F.col("work_order_id").isNull()),
            ("missing_part", F.col("part_id").isNull()),
            ("invalid_status", ~F.coalesce(F.col("status").isin(*WORK_ORDER_STATUSES), F.lit(False))),
            ("invalid_order_date", iso_date("order_date").isNull()),
        ],
        parents=[("part_id", silver_parts, "part_id", "orphan_part")],
    )


def promote_work_orders(bronze: DataFrame, silver_parts: DataFrame, as_of=DEFAULT_AS_OF, corrections=None) -> Promotion:
    return promote(bronze, work_orders_spec(silver_parts), as_of, corrections)


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------

CLOSED_STATES = ["CLOSED", "PARTIAL"]


def month_of(col: str) -> Column:
    """``FORMAT(TRY_CONVERT(DATE, c), 'yyyy-MM')``: null when unparseable."""
    return F.date_format(F.col(col).cast("string").try_cast("date"), "yyyy-MM")


def silver_aggregate(work_orders: DataFrame, parts: DataFrame) -> DataFrame:
    """Month × supplier totals of CLOSED / PARTIAL work orders (silver side of
    the gold reconciliation).  Filter and projection reach the scan; the join
    and the aggregate each shuffle once on their keys."""
    wo = work_orders.filter(F.col("status").isin(*CLOSED_STATES)).select(
        "work_order_id", "part_id", "order_date", "total_cost", "defect_count", "quantity_ordered", "quantity_received"
    )
    p = parts.select("part_id", "supplier_id")
    return (
        wo.join(p, "part_id", "inner")
        .groupBy(month_of("order_date").alias("metric_month"), F.col("supplier_id"))
        .agg(
            F.sum(F.col("total_cost").cast("decimal(18,2)")).cast("double").alias("silver_total_spend"),
            F.sum("defect_count").cast("bigint").alias("silver_defect_count"),
            F.countDistinct("work_order_id").alias("silver_order_count"),
            F.sum("quantity_ordered").cast("bigint").alias("silver_qty_ordered"),
            F.sum("quantity_received").cast("bigint").alias("silver_qty_received"),
        )
    )


def build_gold(work_orders: DataFrame, parts: DataFrame, suppliers: DataFrame, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Month × supplier production KPIs from silver.

    ``quality_score`` has no formula in the reference; it is taken from the
    supplier's promoted ``quality_rating`` (an input, not a derived KPI).
    """
    closed = F.coalesce(F.col("status").isin(*CLOSED_STATES), F.lit(False))

    def when_closed(c):
        return F.when(closed, c).otherwise(F.lit(0))

    # what the totals need of a row is worked out before the join, so no dates or states are shuffled
    wo = work_orders.select(
        "part_id", month_of("order_date").alias("metric_month"), closed.alias("closed"),
        F.when(closed, F.col("work_order_id")).alias("closed_id"),
        when_closed(F.col("quantity_ordered")).alias("ordered"),
        when_closed(F.col("quantity_received")).alias("received"),
        when_closed(F.col("total_cost").cast("decimal(18,2)")).alias("spend"),
        when_closed(F.col("defect_count")).alias("defects"),
        when_closed((F.col("actual_delivery") <= F.col("expected_delivery")).cast("int")).alias("on_time"),
    )
    p = parts.select("part_id", "supplier_id", "lead_time_days")
    agg = (
        wo.join(p, "part_id", "inner")
        .groupBy("metric_month", "supplier_id")
        .agg(
            F.countDistinct("closed_id").alias("total_orders"),
            F.sum("ordered").cast("bigint").alias("total_parts_ordered"),
            F.sum("received").cast("bigint").alias("total_parts_received"),
            F.sum("spend").cast("double").alias("total_spend"),
            F.sum("defects").cast("bigint").alias("defect_count"),
            F.sum(F.col("closed").cast("int")).cast("bigint").alias("closed_lines"),
            F.sum("on_time").cast("bigint").alias("on_time_delivery_count"),
            F.sum(F.when(F.col("closed"), F.col("lead_time_days")).otherwise(F.lit(0))).cast("bigint").alias("lead_sum"),
        )
    )
    s = suppliers.select("supplier_id", F.col("supplier_name"), F.col("quality_rating").alias("quality_score"))
    pct = lambda num, den: F.when(F.col(den) > 0, F.round(F.col(num).cast("double") * 100.0 / F.col(den).cast("double"), 2)).otherwise(F.lit(0.0))
    return agg.join(s, "supplier_id", "left").select(
        "metric_month",
        "supplier_id",
        "supplier_name",
        "total_orders",
        "total_parts_ordered",
        "total_parts_received",
        "total_spend",
        "defect_count",
        pct("defect_count", "total_parts_received").alias("defect_rate_pct"),
        "on_time_delivery_count",
        pct("on_time_delivery_count", "closed_lines").alias("on_time_delivery_pct"),
        F.when(F.col("closed_lines") > 0, F.round(F.col("lead_sum").cast("double") / F.col("closed_lines").cast("double"), 2))
        .otherwise(F.lit(0.0))
        .alias("avg_lead_time_days"),
        "quality_score",
        _as_of_date(as_of).alias("dq_load_date"),
    )
