"""Consistency checks: accepted values, ranges, formats, foreign keys, dates."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import EMAIL_PATTERN, matches_strptime, strip_ws, to_number
from ._common import keys_of, require

_LENIENT_TS = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?$"


def not_in_set(col: str, accepted: Sequence, null_is_violation: bool = True) -> Column:
    c = F.col(col)
    inside = c.isin(*accepted)
    return ~F.coalesce(inside, F.lit(False)) if null_is_violation else c.isNotNull() & ~inside


def accepted_values(df: DataFrame, column: str, accepted: Sequence, null_is_violation: bool = True) -> DataFrame:
    """Bad values with their row counts (value, n_rows); where null is a
    violation, the nulls are a row of their own, so no failure reads as a pass."""
    require(df, column)
    bad = df.filter(not_in_set(column, accepted, null_is_violation))
    return (
        bad.groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def accepted_values_rows(df: DataFrame, key_cols, column: str, accepted: Sequence, null_is_violation: bool = True) -> DataFrame:
    require(df, column)
    return df.filter(not_in_set(column, accepted, null_is_violation)).select(
        *keys_of(key_cols), F.col(column).cast("string").alias("value")
    )


def out_of_range(col: str, min_val=None, max_val=None, allow_null: bool = True) -> Column:
    x = to_number(col)
    bad = F.lit(False)
    if min_val is not None:
        bad = bad | F.coalesce(x < F.lit(float(min_val)), F.lit(False))
    if max_val is not None:
        bad = bad | F.coalesce(x > F.lit(float(max_val)), F.lit(False))
    if not allow_null:
        bad = bad | x.isNull()
    return bad


def numeric_range(df: DataFrame, key_cols, column: str, min_val=None, max_val=None, allow_null: bool = True) -> DataFrame:
    """Rows outside [min_val, max_val] (inclusive); non-numeric text is null,
    and null violates only when ``allow_null`` is false."""
    require(df, column)
    return df.filter(out_of_range(column, min_val, max_val, allow_null)).select(
        *keys_of(key_cols), F.col(column).cast("string").alias("value")
    )


def date_format(df: DataFrame, key_cols, column: str, fmt: str = "%Y-%m-%d") -> DataFrame:
    """Non-null values that do not parse exactly with the strftime ``fmt``."""
    require(df, column)
    c = F.col(column)
    return df.filter(c.isNotNull() & ~matches_strptime(c, fmt)).select(*keys_of(key_cols), c.cast("string").alias("value"))


def bad_email(col: str) -> Column:
    c = F.col(col)
    return c.isNotNull() & ~strip_ws(c.cast("string")).rlike(EMAIL_PATTERN)


def email_format(df: DataFrame, key_cols, column: str) -> DataFrame:
    require(df, column)
    return df.filter(bad_email(column)).select(*keys_of(key_cols), F.col(column).cast("string").alias("value"))


def referential_integrity(
    df: DataFrame, key_cols, fk_column: str, reference_df: DataFrame, pk_column: str, allow_null: bool = True
) -> DataFrame:
    """Child rows whose key (compared as text) is absent from the parent.

    One anti join (``skew.missing``), whose hot partitions adaptive execution
    splits.  ``allow_null=False`` makes a null foreign key an orphan.
    """
    from .skew import missing

    require(df, fk_column)
    child = df.select(*keys_of(key_cols), F.col(fk_column).alias("orphan_value"),
                      F.col(fk_column).cast("string").alias("__fk_text"))
    if allow_null:
        child = child.filter(F.col("orphan_value").isNotNull())
    parent = reference_df.select(F.col(pk_column).cast("string").alias("__pk_text"))
    return missing(child, "__fk_text", parent, "__pk_text").select(*keys_of(key_cols), "orphan_value")


def lenient_timestamp(col) -> Column:
    s = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.when(s.rlike(_LENIENT_TS), F.try_to_timestamp(s))


def as_of_ts(as_of) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")


def no_future_dates(df: DataFrame, key_cols, column: str, as_of=None) -> DataFrame:
    """Rows whose parsed date is after ``as_of`` midnight (default: today).
    Unparseable values are ignored."""
    require(df, column)
    today = F.to_timestamp(F.to_date(as_of_ts(as_of)))
    return df.filter(lenient_timestamp(column) > today).select(*keys_of(key_cols), F.col(column).cast("string").alias("value"))


def column_order_rule(df: DataFrame, key_cols, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows breaking ``small <= large`` for each (small, large) pair; one scan."""
    from ._common import flag_rows

    flags = [
        (f"{a}<={b}", F.col(a) > F.col(b), F.concat_ws(">", F.col(a).cast("string"), F.col(b).cast("string")))
        for a, b in rules
    ]
    return flag_rows(df, key_cols, flags, names=("rule", "value"))


def ratio_consistency(
    df: DataFrame, key_cols, stored: str, numerator: str, denominator: str, tolerance: float = 0.1, scale: float = 100.0
) -> DataFrame:
    """Stored rate vs numerator / denominator × scale, both rounded to 2 dp;
    rows with denominator > 0 whose difference exceeds ``tolerance``."""
    computed = F.round(F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double")) * F.lit(scale), 2)
    stored_r = F.round(F.col(stored).cast("double"), 2)
    return df.filter((F.col(denominator) > 0) & (F.abs(stored_r - computed) > F.lit(tolerance))).select(
        *keys_of(key_cols), stored_r.alias("stored_rate"), computed.alias("computed_rate")
    )


def no_negative(df: DataFrame, key_cols, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0).select(*keys_of(key_cols), F.col(column))


def expression_is_true(df: DataFrame, key_cols, expressions: dict[str, str]) -> DataFrame:
    """dbt ``expression_is_true``: per column, rows where its SQL expression is
    false (null passes, as in ``WHERE NOT (expr)``); all expressions in one scan."""
    from ._common import flag_rows

    flags = [(col, ~F.expr(e), F.col(col)) for col, e in expressions.items()]
    return flag_rows(df, key_cols, flags)
