"""Cross-layer reconciliation: counts, phantom keys, sums, dropped rows, lineage."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import to_number
from ._common import require


def _count(df: DataFrame) -> Column:
    """Row count of ``df`` as a scalar subquery: Spark runs it once and inlines the value."""
    return df.agg(F.count(F.lit(1))).scalar()


def row_count_delta(source: DataFrame, target: DataFrame, max_drop_pct: float = 5.0, max_gain_pct: float = 0.0) -> DataFrame:
    """One row: source_rows, target_rows, drop_pct, gain_pct (2 dp), passed.
    Drop and gain are % of the source; an empty source fails."""
    s = F.col("source_rows").cast("double")
    t = F.col("target_rows").cast("double")
    drop = F.when(s > 0, F.greatest(F.lit(0.0), (s - t) / s * 100))
    gain = F.when(s > 0, F.greatest(F.lit(0.0), (t - s) / s * 100))
    counts = source.agg(F.count(F.lit(1)).alias("source_rows")).select("source_rows", _count(target).alias("target_rows"))
    return counts.select(
        "source_rows",
        "target_rows",
        F.round(drop, 2).alias("drop_pct"),
        F.round(gain, 2).alias("gain_pct"),
        F.coalesce((drop <= max_drop_pct) & (gain <= max_gain_pct), F.lit(False)).alias("passed"),
    )


def _text_keys(df: DataFrame, col: str) -> DataFrame:
    return df.select(F.col(col).cast("string").alias("pk_value")).dropna().distinct()


def no_new_pks(source: DataFrame, target: DataFrame, pk_column: str, target_pk: str | None = None) -> DataFrame:
    """Distinct non-null keys (as text) in ``target`` that ``source`` lacks."""
    require(source, pk_column)
    return _text_keys(target, target_pk or pk_column).join(_text_keys(source, pk_column), "pk_value", "left_anti")


def numeric_sum_match(
    source: DataFrame,
    target: DataFrame,
    column: str,
    tolerance_pct: float = 0.01,
    source_filter: Column | None = None,
    target_filter: Column | None = None,
    target_column: str | None = None,
    scale: int = 6,
) -> DataFrame:
    """One row: source_sum, target_sum, diff_pct, passed.

    Non-numeric text is ignored; sums are exact decimals (order-independent),
    both zero → pass; zero source and non-zero target → infinite diff (null
    here) → fail; passes iff diff_pct <= tolerance_pct (a percentage).
    """
    src = source if source_filter is None else source.filter(source_filter)
    tgt = target if target_filter is None else target.filter(target_filter)
    dec = f"decimal(38,{scale})"
    ssum = F.coalesce(F.sum(to_number(column).cast(dec)), F.lit(0).cast(dec)).cast("double")
    tsum = tgt.agg(F.coalesce(F.sum(to_number(target_column or column).cast(dec)), F.lit(0).cast(dec)).cast("double")).scalar()
    both = src.agg(ssum.alias("source_sum")).select("source_sum", tsum.alias("target_sum"))
    s, t = F.col("source_sum"), F.col("target_sum")
    diff = F.when(s != 0, F.abs(s - t) / F.abs(s) * 100)
    return both.select(
        "source_sum",
        "target_sum",
        diff.alias("diff_pct"),
        F.when((s == 0) & (t == 0), F.lit(True)).otherwise(F.coalesce(diff <= F.lit(float(tolerance_pct)), F.lit(False))).alias("passed"),
    )


def no_dropped_critical(source: DataFrame, target: DataFrame, pk_column: str, filter_column: str, critical_value) -> DataFrame:
    """Distinct keys of critical source rows that the target lost."""
    crit = source.filter(F.col(filter_column) == F.lit(critical_value)).select(F.col(pk_column).cast("string").alias("pk_value")).distinct()
    kept = target.select(F.col(pk_column).cast("string").alias("pk_value"))
    return crit.join(kept, "pk_value", "left_anti")  # distinct first: a hot key is one row


def multi_entity_sla(pairs: Sequence[tuple[str, DataFrame, DataFrame, float]], max_gain_pct: float = 0.0) -> DataFrame:
    """Row-drop SLA for several (entity, source, target, max_drop_pct) at once: one row each."""
    out = None
    for entity, src, tgt, max_drop in pairs:
        part = row_count_delta(src, tgt, max_drop, max_gain_pct).select(F.lit(entity).alias("entity"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def multi_entity_phantoms(pairs: Sequence[tuple[str, DataFrame, DataFrame, str]]) -> DataFrame:
    """Phantom keys for several (entity, source, target, pk) at once."""
    out = None
    for entity, src, tgt, pk in pairs:
        part = no_new_pks(src, tgt, pk).select(F.lit(entity).alias("entity"), "pk_value")
        out = part if out is None else out.unionByName(part)
    return out


def lineage_trace(downstream: DataFrame, upstream: DataFrame, column: str, upstream_column: str | None = None,
                  exclude: Sequence[str] = ()) -> DataFrame:
    """Distinct downstream ids (as text) untraceable to the upstream table, minus known exclusions."""
    down = _text_keys(downstream, column)
    if exclude:
        down = down.filter(~F.col("pk_value").isin(*exclude))
    up = upstream.select(F.col(upstream_column or column).cast("string").alias("pk_value")).dropna().distinct()
    return down.join(up, "pk_value", "left_anti")
