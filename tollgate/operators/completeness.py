"""Completeness checks: null rates, row counts, blanks, padding, key uniqueness."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import count_if
from ..functions.text import is_blank, strip_ws
from ._common import flag_rows, keys_of, require


def null_rates(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    threshold: float = 0.05,
    blank_is_null: bool = False,
) -> DataFrame:
    """Per-column null count and rate in **one** aggregation pass.

    ``columns`` None or empty → all columns.  A column violates iff its rate is
    strictly above ``threshold``; an empty table has rate 0.  Result columns:
    column_name, total_rows, null_count, null_rate_pct (2 dp), threshold_pct, passed.
    """
    cols = list(columns) if columns else list(df.columns)
    require(df, *cols)

    def is_missing(c: str) -> Column:
        return (F.col(c).isNull() | is_blank(c)) if blank_is_null else F.col(c).isNull()

    aggs = [F.count(F.lit(1)).alias("__total")] + [count_if(is_missing(c)).alias(f"__n{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    per_col = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__n{i}").alias("null_count")) for i, c in enumerate(cols)])
    )
    rows = one.select(F.col("__total").alias("total_rows"), per_col.alias("__c")).select(
        "__c.column_name", "total_rows", F.coalesce("__c.null_count", F.lit(0)).cast("bigint").alias("null_count")
    )
    rate = F.when(F.col("total_rows") > 0, F.col("null_count") / F.col("total_rows")).otherwise(F.lit(0.0))
    return rows.select(
        "column_name",
        "total_rows",
        "null_count",
        F.round(rate * 100, 2).alias("null_rate_pct"),
        F.round(F.lit(float(threshold)) * 100, 2).alias("threshold_pct"),
        (rate <= F.lit(float(threshold))).alias("passed"),
    )


def required_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Missing column names (schema only; runs no job)."""
    return [c for c in required if c not in df.columns]


def row_count(df: DataFrame, min_rows: int, max_rows: int | None = None) -> DataFrame:
    """One row: total_rows, min_rows, max_rows, passed (both bounds inclusive)."""
    n = F.count(F.lit(1))
    ok = n >= F.lit(min_rows)
    if max_rows is not None:
        ok = ok & (n <= F.lit(max_rows))
    return df.agg(
        n.alias("total_rows"),
        F.lit(min_rows).cast("bigint").alias("min_rows"),
        F.lit(max_rows).cast("bigint").alias("max_rows"),
        ok.alias("passed"),
    )


def empty_strings(df: DataFrame, key_cols, columns: Sequence[str]) -> DataFrame:
    """Rows whose value is empty after strip; null is *not* empty; unknown columns are skipped."""
    flags = [(c, is_blank(c), F.col(c)) for c in columns if c in df.columns]
    return flag_rows(df, key_cols, flags).drop("value")


def whitespace_padding(df: DataFrame, key_cols, columns: Sequence[str]) -> DataFrame:
    """Non-null values that differ from their stripped form (any whitespace kind)."""
    flags = [(c, F.col(c).isNotNull() & (F.col(c).cast("string") != strip_ws(F.col(c).cast("string"))), F.col(c))
             for c in columns if c in df.columns]
    return flag_rows(df, key_cols, flags)


def pk_unique(df: DataFrame, pk_cols, ignore_nulls: bool = False) -> DataFrame:
    """Key values held by more than one row, with their row count.

    Nulls group together (pandas ``duplicated`` semantics) unless
    ``ignore_nulls`` (dbt / GE ``unique``).  A hot key costs nothing extra: the
    count is combined map-side before the shuffle.
    """
    keys = keys_of(pk_cols)
    require(df, *keys)
    src = df.select(*keys)
    if ignore_nulls:
        src = src.dropna(subset=keys)
    return src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def composite_pk_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return pk_unique(df, list(cols))


def conditional_not_null(df: DataFrame, key_cols, condition: Column, column: str) -> DataFrame:
    """Rows where ``condition`` holds and ``column`` is null (e.g. CLOSED without delivery date)."""
    require(df, column)
    return df.filter(F.coalesce(condition, F.lit(False)) & F.col(column).isNull()).select(*keys_of(key_cols))
