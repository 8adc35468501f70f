"""Declarative check suites compiled into one aggregation pass per table.

A suite is a list of ``Check`` specs.  Every per-row check contributes two
aggregate expressions (rows evaluated, rows failing) to a single ``agg`` over
the table — N checks, one scan, one tiny partial-aggregate shuffle.  Checks
that need a shuffle (uniqueness, distinct values, foreign keys) share one too
(``plans.keyed``).  Schema checks are decided on the driver from the schema
alone.  The result is a lazy DataFrame with one row
per check; nothing is collected unless the caller asks for the verdict.
"""
from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.metrics import count_if
from . import keyed

RESULT_COLUMNS = [
    "layer", "table_name", "rule", "column_name", "severity", "total_rows", "evaluated_rows", "failing_rows",
    "conforming_ratio", "mostly", "max_allowed", "passed",
]

ROW_KINDS = {"not_null", "in_set", "between", "match_regex", "strftime", "expression", "not_empty", "not_padded", "null_rate"}
SHUFFLE_KINDS = keyed.KEY_KINDS
SCHEMA_KINDS = {"columns_match", "required_columns"}


@dataclass(frozen=True)
class Check:
    kind: str
    column: str | None = None
    params: dict = field(default_factory=dict, hash=False, compare=False)
    mostly: float | None = None
    max_allowed: int | None = None
    severity: str = "error"
    name: str | None = None

    @property
    def rule(self) -> str:
        return self.name or self.kind


NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def q(name: str) -> str:
    """Backtick-quote an identifier for Spark SQL."""
    return "`" + name.replace("`", "``") + "`"


def lit_sql(v) -> str:
    """A Spark SQL literal (backslashes and quotes escaped for the SQL parser)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(float(v)) if isinstance(v, float) else str(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def row_condition_sql(check: Check, dtypes: dict[str, str] | None = None) -> tuple[str, str]:
    """(evaluated, failing) row predicates of a per-row check, as Spark SQL."""
    from ..functions.text import _translate

    dtypes = dtypes or {}
    c = q(check.column) if check.column else None
    p = check.params
    text = f"CAST({c} AS STRING)" if c else None
    if check.kind == "not_null":
        return "true", f"{c} IS NULL"
    if check.kind == "null_rate":
        blank = f" OR regexp_replace({text}, '^\\\\s+|\\\\s+$', '') = ''" if p.get("blank_is_null") else ""
        return "true", f"({c} IS NULL{blank})"
    if check.kind == "in_set":
        vals = ", ".join(lit_sql(v) for v in p["values"])
        if p.get("null_is_violation", False):
            return "true", f"NOT coalesce({c} IN ({vals}), false)"
        return f"{c} IS NOT NULL", f"NOT ({c} IN ({vals}))"
    if check.kind == "between":
        numeric = dtypes.get(check.column, "string").startswith(NUMERIC_TYPES)
        x = f"CAST({c} AS DOUBLE)" if numeric else f"try_cast({text} AS DOUBLE)"
        bad = [f"{x} IS NULL"]
        if p.get("min") is not None:
            bad.append(f"{x} < {float(p['min'])!r}")
        if p.get("max") is not None:
            bad.append(f"{x} > {float(p['max'])!r}")
        return f"{c} IS NOT NULL", "(" + " OR ".join(bad) + ")"
    if check.kind == "match_regex":
        return f"{c} IS NOT NULL", f"NOT ({text} RLIKE {lit_sql(p['regex'])})"
    if check.kind == "strftime":
        guard, pattern = _translate(p.get("format", "%Y-%m-%d"))
        return f"{c} IS NOT NULL", f"NOT ({text} RLIKE {lit_sql(guard)} AND try_to_timestamp({text}, {lit_sql(pattern)}) IS NOT NULL)"
    if check.kind == "expression":
        return "true", f"NOT ({p['expr']})"
    if check.kind == "not_empty":
        return f"{c} IS NOT NULL", f"regexp_replace({text}, '^\\\\s+|\\\\s+$', '') = ''"
    if check.kind == "not_padded":
        return f"{c} IS NOT NULL", f"regexp_replace({text}, '^\\\\s+|\\\\s+$', '') != {text}"
    raise ValueError(f"not a per-row check kind: {check.kind}")


def row_condition(check: Check, dtypes: dict[str, str] | None = None) -> tuple[Column, Column]:
    ev, bad = row_condition_sql(check, dtypes)
    return F.expr(ev), F.expr(bad)


def _verdict_sql(check: Check, total: str, ev: str, bad: str) -> str:
    if check.kind == "null_rate":
        thr = float(check.params.get("threshold", 0.0))
        return f"(CASE WHEN {total} > 0 THEN CAST({bad} AS DOUBLE) / CAST({total} AS DOUBLE) ELSE 0.0 END) <= {thr!r}"
    if check.mostly is not None:
        return (f"coalesce(CASE WHEN {ev} > 0 THEN CAST({ev} - {bad} AS DOUBLE) / CAST({ev} AS DOUBLE) END "
                f">= {float(check.mostly)!r}, true)")
    if check.max_allowed is not None:
        return f"{bad} <= {int(check.max_allowed)}"
    return f"{bad} = 0"


def _row_sql(check: Check, layer: str, table: str, total: str, ev: str, bad: str, missing: bool = False) -> str:
    """One result row as a ``named_struct`` over aggregate outputs.  A check of a
    *missing* column fails, whatever it tolerates."""
    verdict = "false" if missing else _verdict_sql(check, total, ev, bad)
    ratio = f"round(CASE WHEN {ev} > 0 THEN CAST({ev} - {bad} AS DOUBLE) / CAST({ev} AS DOUBLE) END, 6)"
    return (f"named_struct('layer', {lit_sql(layer)}, 'table_name', {lit_sql(table)}, 'rule', {lit_sql(check.rule)}, "
            f"'column_name', CAST({lit_sql(check.column)} AS STRING), 'severity', {lit_sql(check.severity)}, "
            f"'total_rows', CAST({total} AS BIGINT), 'evaluated_rows', CAST({ev} AS BIGINT), "
            f"'failing_rows', CAST({bad} AS BIGINT), 'conforming_ratio', {ratio}, "
            f"'mostly', CAST({lit_sql(check.mostly)} AS DOUBLE), 'max_allowed', CAST({lit_sql(check.max_allowed)} AS BIGINT), "
            f"'passed', {verdict})")


def _resolves(df: DataFrame, expr: str) -> bool:
    """Whether the columns of an expression exist (analysis only, no job)."""
    try:
        df.selectExpr(f"({expr}) AS __x")
    except AnalysisException as e:
        if "UNRESOLVED_COLUMN" in (e.getCondition() or ""):
            return False
        raise
    return True


def _fused_sql(df: DataFrame, checks: Sequence[Check], layer: str, table: str) -> tuple[list[str], list[str]]:
    """(aggregates, result rows over them) of the per-row, row-count and schema checks."""
    dtypes = dict(df.dtypes)
    aggs = ["count(1) AS __total"]
    rows = []
    for i, ch in enumerate(checks):
        if ch.kind in ROW_KINDS:
            if (ch.column is not None and ch.column not in dtypes) or (ch.kind == "expression" and not _resolves(df, ch.params["expr"])):
                rows.append(_row_sql(ch, layer, table, "__total", "0", "1", missing=True))
                continue
            ev, bad = row_condition_sql(ch, dtypes)
            aggs.append(f"count_if({ev}) AS __e{i}")
            aggs.append(f"count_if(({ev}) AND coalesce({bad}, false)) AS __f{i}")
            rows.append(_row_sql(ch, layer, table, "__total", f"__e{i}", f"__f{i}"))
        elif ch.kind == "row_count":
            lo, hi = ch.params.get("min"), ch.params.get("max")
            bad = " OR ".join(([f"__total < {lo}"] if lo is not None else []) + ([f"__total > {hi}"] if hi is not None else [])) or "false"
            rows.append(_row_sql(ch, layer, table, "__total", "1", f"CAST({bad} AS INT)"))
        elif ch.kind in SCHEMA_KINDS:
            wanted = list(ch.params["columns"])
            missing = [c for c in wanted if c not in dtypes]
            extra = [c for c in df.columns if c not in wanted] if ch.params.get("exact") else []
            rows.append(_row_sql(ch, layer, table, "__total", str(len(wanted)), str(len(missing) + len(extra))))
    return aggs, rows


def _fused(df: DataFrame, checks: Sequence[Check], layer: str, table: str) -> DataFrame:
    """All per-row checks (plus row-count and schema checks) from ONE aggregate.

    The plan is Scan → partial HashAggregate → one-row Exchange → final
    HashAggregate → Generate: one pass over the table whatever the number of
    checks.  Expressions are assembled as SQL text so building a large suite
    costs two calls into the JVM, not thousands.
    """
    aggs, rows = _fused_sql(df, checks, layer, table)
    if not rows:
        return None
    one = df.selectExpr(*aggs)
    return one.selectExpr(f"explode(array({', '.join(rows)})) AS __r").select("__r.*")


def _keyed(df: DataFrame, checks: Sequence[Check], layer: str, table: str) -> DataFrame:
    """All checks that need a shuffle, from one scan and one shuffle of (check, value) counts."""
    here = [ch for ch in checks if ch.column in df.columns]
    rows = [_row_sql(ch, layer, table, f"__t{i}", f"__e{i}", f"__f{i}") for i, ch in enumerate(here)]
    gone = [_row_sql(ch, layer, table, "__total", "0", "1", missing=True) for ch in checks if ch.column not in df.columns]
    if not here:
        return df.selectExpr("count(1) AS __total").selectExpr(f"explode(array({', '.join(gone)})) AS __r").select("__r.*")
    one = keyed.key_stats(df, here, q, lit_sql).withColumn("__total", F.col("__t0"))  # every row has a pair of the first check
    return one.selectExpr(f"explode(array({', '.join(rows + gone)})) AS __r").select("__r.*")


def run_suite(df: DataFrame, checks: Sequence[Check], table: str = "table", layer: str = "bronze") -> DataFrame:
    """One result row per check (lazy).  Per-row checks share one table scan, checks that need a shuffle another."""
    unknown = {ch.kind for ch in checks} - ROW_KINDS - SHUFFLE_KINDS - SCHEMA_KINDS - {"row_count"}
    if unknown:
        raise ValueError(f"unknown kinds of check: {sorted(unknown)}")
    parts = []
    fused = _fused(df, checks, layer, table)
    if fused is not None:
        parts.append(fused)
    shuffled = [ch for ch in checks if ch.kind in SHUFFLE_KINDS]
    if shuffled:
        parts.append(_keyed(df, shuffled, layer, table))
    if not parts:  # an empty suite: no result rows, same schema
        empty = Check("row_count", None, {"min": None, "max": None})
        return _fused(df, [empty], layer, table).filter(F.lit(False)).select(*RESULT_COLUMNS)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*RESULT_COLUMNS)


def write_with_suite(df: DataFrame, path: str, checks: Sequence[Check], table: str = "table", layer: str = "bronze") -> tuple[DataFrame, DataFrame]:
    """(written table, results): write *df* as Parquet and check it on the way.

    Per-row, row-count and schema checks are metrics observed by the write itself, so they cost no scan of their own.
    Checks that need a shuffle read the written columns.  Metrics of a task that ran twice (a lost executor) could
    count twice; the observed row count is therefore compared with the written table's (from the file footers), and
    on any difference the checks read the written table instead.
    """
    spark = df.sparkSession
    fused = [ch for ch in checks if ch.kind not in SHUFFLE_KINDS]
    aggs, rows = _fused_sql(df, fused, layer, table)
    seen = Observation()
    df.observe(seen, *map(F.expr, aggs)).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    numbers = seen.get
    if numbers["__total"] != out.count():
        return out, run_suite(out, checks, table, layer)
    parts = []
    if rows:
        values = ", ".join(f"CAST({numbers[name]} AS BIGINT) AS {name}" for name in (a.rpartition(" AS ")[2] for a in aggs))
        parts.append(spark.sql(f"SELECT {values}").selectExpr(f"explode(array({', '.join(rows)})) AS __r").select("__r.*").select(*RESULT_COLUMNS))
    shuffled = [ch for ch in checks if ch.kind in SHUFFLE_KINDS]
    if shuffled or not rows:
        parts.append(run_suite(out, shuffled, table, layer))
    return out, parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def verdict(violations: DataFrame, rule: str, table: str, layer: str, column: str | None = None, max_allowed: int | None = None,
            severity: str = "error") -> DataFrame:
    """One result row for a check that returns its violating rows (padding, formats, foreign keys, outliers, order
    rules, ...), so that it can enter a gate beside the suites; the rows themselves stay available."""
    check = Check("rows", column, max_allowed=max_allowed, severity=severity, name=rule)
    counted = violations.agg(F.count(F.lit(1)).alias("__bad"))
    null = "CAST(NULL AS BIGINT)"
    return counted.selectExpr(f"{_row_sql(check, layer, table, null, null, '__bad')} AS r").select("r.*").select(*RESULT_COLUMNS)


def unexpected_rows(df: DataFrame, checks: Sequence[Check], key_cols: Sequence[str]) -> DataFrame:
    """Violating rows (keys, rule, column, value) of every check of rows, never collected by default (the
    ``include_unexpected_rows`` option): lazily in one scan for per-row checks; checks that need a shuffle first write
    their failing values (see ``plans.keyed``).  Checks of the whole table (row count, columns) have no rows."""
    dtypes = dict(df.dtypes)
    shuffled = [ch for ch in checks if ch.kind in SHUFFLE_KINDS - {"bad_values"} and ch.column in dtypes]
    arms = []
    for ch in checks:
        if ch.kind not in ROW_KINDS | {"bad_values"} or (ch.column and ch.column not in dtypes):
            continue
        if ch.kind == "bad_values":  # each row shows it
            ev, bad = f"{q(ch.column)} IS NOT NULL", keyed.failing(ch, keyed.key_text(q(ch.column), dtypes[ch.column]), lit_sql)
        else:
            ev, bad = row_condition_sql(ch, dtypes)
        val = f"CAST({q(ch.column)} AS STRING)" if ch.column else "CAST(NULL AS STRING)"
        arms.append(f"CASE WHEN coalesce(({ev}) AND ({bad}), false) THEN named_struct('rule', {lit_sql(ch.rule)}, "
                    f"'column_name', CAST({lit_sql(ch.column)} AS STRING), 'value', {val}) END")
    if not arms:
        arms = ["CAST(NULL AS STRUCT<rule: STRING, column_name: STRING, value: STRING>)"]
    out = df.selectExpr(*[q(k) for k in key_cols], f"explode(array({', '.join(arms)})) AS __u").filter("__u IS NOT NULL")
    out = out.select(*key_cols, "__u.rule", "__u.column_name", "__u.value")
    return out.unionByName(keyed.failing_rows(df, shuffled, key_cols, q, lit_sql)) if shuffled else out


def run_gate(results: DataFrame) -> DataFrame:
    """Per layer: checks, failed error-severity checks, gate_passed (warn never blocks)."""
    err = F.col("severity") == "error"
    return results.groupBy("layer").agg(
        F.count(F.lit(1)).alias("checks"),
        count_if(err & ~F.col("passed")).alias("failed_checks"),
        count_if(~err & ~F.col("passed")).alias("warnings"),
        F.coalesce(F.bool_and(F.when(err, F.col("passed"))), F.lit(True)).alias("gate_passed"),
    )


def run_name(layer: str, now: _dt.datetime | None = None) -> str:
    """``%Y%m%d-%H%M%S-<layer>-gate``."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return f"{now:%Y%m%d-%H%M%S}-{layer}-gate"


def gate_verdict(results: DataFrame) -> bool:
    """The one driver-side answer: does every error-severity check pass?  (one tiny row)"""
    row = results.agg(F.coalesce(F.bool_and(F.when(F.col("severity") == "error", F.col("passed"))), F.lit(True)).alias("ok")).first()
    return bool(row["ok"])
