"""Key checks of a table in one shuffle: uniqueness, accepted distinct values, foreign keys.

Every check turns a row into one (check, value) pair; all pairs of a table are
exploded from one scan and counted together.  The count is combined before the
shuffle, so a value that holds a third of the rows is one row a task.  Parents of
foreign keys are reduced to (check, value) likewise and joined to the counts, where
each pair occurs once on either side.  The numbers of all checks come from one
global aggregate over the counts.

Values are compared as text in which equal values are equal: numbers without a
negative zero, binary as hexadecimal, nested types as JSON.  A foreign key and its
parent of different integer types compare as 64-bit integers; a decimal and an
integer as decimals of 18 places; other unlike numbers as doubles; anything else as
text.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators._common import written

KEY_KINDS = {"unique", "unique_values", "relationship", "bad_values"}
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def key_text(column: str, dtype: str, other: str | None = None) -> str:
    """SQL text of a quoted *column*'s value, as compared with a column of type *other*."""
    is_number = lambda t: t in _INTEGERS or t in ("float", "double") or t.startswith("decimal")
    if other and other != dtype and is_number(dtype) and is_number(other):
        if dtype in _INTEGERS and other in _INTEGERS:
            return f"CAST(CAST({column} AS BIGINT) AS STRING)"
        if not {dtype, other} & {"float", "double"}:
            return f"CAST(CAST({column} AS DECIMAL(38, 18)) AS STRING)"
        return f"CAST(CAST({column} AS DOUBLE) + 0.0D AS STRING)"
    if dtype in ("float", "double"):
        return f"CAST(CAST({column} AS DOUBLE) + 0.0D AS STRING)"
    if dtype == "binary":
        return f"hex({column})"
    if dtype.startswith(("array", "struct", "map")):
        return f"CASE WHEN {column} IS NOT NULL THEN to_json({column}) END"
    return f"CAST({column} AS STRING)"


def _text_of(df: DataFrame, check, quote) -> str:
    parent = check.params.get("parent") if check.kind == "relationship" else None
    other = dict(parent.dtypes)[check.params.get("pk", check.column)] if parent is not None else None
    return key_text(quote(check.column), dict(df.dtypes)[check.column], other)


def key_counts(df: DataFrame, checks: Sequence, quote) -> DataFrame:
    """(check, value, n, known): how often each value of each check's column occurs, nulls too; *known* is true where a
    foreign key's parent has it."""
    pairs = ", ".join(f"named_struct('check', {i}, 'value', {_text_of(df, ch, quote)})" for i, ch in enumerate(checks))
    counts = (df.selectExpr(f"explode(array({pairs})) AS __p").select("__p.check", "__p.value")
              .groupBy("check", "value").agg(F.count(F.lit(1)).alias("n")))
    parents = None
    for i, ch in enumerate(checks):
        if ch.kind == "relationship":
            parent, pk = ch.params["parent"], ch.params.get("pk", ch.column)
            text = key_text(quote(pk), dict(parent.dtypes)[pk], dict(df.dtypes)[ch.column])
            part = parent.selectExpr(f"{i} AS check", f"{text} AS value").where("value IS NOT NULL")
            parents = part if parents is None else parents.unionByName(part)
    if parents is None:
        return counts.withColumn("known", F.lit(None).cast("boolean"))
    return counts.join(parents.distinct().withColumn("known", F.lit(True)), ["check", "value"], "left")


def failing(check, value: str = "value", quote_value=None) -> str:
    """SQL condition over a row of ``key_counts`` that its value fails *check*."""
    if check.kind in ("unique", "unique_values"):
        return f"{value} IS NOT NULL AND n > 1"
    if check.kind == "relationship":
        return f"{value} IS NOT NULL AND known IS NULL"
    accepted = ", ".join(quote_value(str(v)) for v in check.params["values"])
    return f"{value} IS NOT NULL AND {value} NOT IN ({accepted})"


def key_stats(df: DataFrame, checks: Sequence, quote, quote_value) -> DataFrame:
    """One row with, for each check i, __t{i} (rows), __e{i} (rows with a value) and __f{i} (failing rows; failing values of
    ``unique_values`` and ``bad_values``)."""
    aggs = []
    for i, ch in enumerate(checks):
        bad = f"check = {i} AND {failing(ch, quote_value=quote_value)}"
        aggs += [f"coalesce(sum(CASE WHEN check = {i} THEN n END), 0) AS __t{i}",
                 f"coalesce(sum(CASE WHEN check = {i} AND value IS NOT NULL THEN n END), 0) AS __e{i}",
                 f"count_if({bad}) AS __f{i}" if ch.kind in ("unique_values", "bad_values") else f"coalesce(sum(CASE WHEN {bad} THEN n END), 0) AS __f{i}"]
    return key_counts(df, checks, quote).selectExpr(*aggs)


def failing_rows(df: DataFrame, checks: Sequence, key_cols: Sequence[str], quote, quote_value) -> DataFrame:
    """(key columns, rule, column_name, value) of the rows whose value fails a check.  The failing (check, value) pairs are
    written to the shared folder, each once, and the rows joined to that table: both sides of the join are plain
    shuffles, so adaptive execution can split a value that many rows hold."""
    bad = " OR ".join(f"check = {i} AND {failing(ch, quote_value=quote_value)}" for i, ch in enumerate(checks))
    offenders = written(key_counts(df, checks, quote).where(bad).select("check", "value"), "failing-keys")
    rows = ", ".join(f"named_struct('check', {i}, 'value', {_text_of(df, ch, quote)}, 'rule', {quote_value(ch.rule)}, "
                     f"'column_name', {quote_value(ch.column)}, 'shown', CAST({quote(ch.column)} AS STRING))" for i, ch in enumerate(checks))
    pairs = df.selectExpr(*map(quote, key_cols), f"explode(array({rows})) AS __p").where("__p.value IS NOT NULL")
    pairs = pairs.select(*map(quote, key_cols), F.col("__p.check").alias("__check"), F.col("__p.value").alias("__value"), "__p.rule", "__p.column_name",
                         F.col("__p.shown").alias("value"))
    found = pairs.join(offenders, (pairs["__check"] == offenders["check"]) & (pairs["__value"] == offenders["value"]), "left_semi")
    return found.select(*map(quote, key_cols), "rule", "column_name", "value")
