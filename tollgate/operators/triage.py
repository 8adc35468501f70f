"""Failure triage over a table of check / test run records.

Columns expected: node_id, keywords (comma-separated markers), outcome,
longrepr (multi-line failure log).  Everything is a built-in expression over
the lines array (``split`` + higher-order ``transform`` / ``filter``), so the
job stays in whole-stage code and scales with the number of records.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Exception names in priority order, infrastructure classes,
# layer names and the decision reasons of the reference's triage tool.
KNOWN_EXCEPTION_NAMES = [
    "FileNotFoundError", "ModuleNotFoundError", "ImportError", "AttributeError", "KeyError", "TypeError", "OSError",
    "AssertionError", "ValueError", "RuntimeError", "PermissionError", "NotImplementedError", "IndexError",
    "StopIteration", "TimeoutError", "ConnectionError", "NameError",
]
INFRA_ERRORS = ["FileNotFoundError", "ModuleNotFoundError", "ImportError", "AttributeError", "KeyError", "TypeError", "OSError"]
LAYERS = ["bronze", "silver", "gold", "integration", "sql"]
ASSERTION_REASONS = {
    "silver": "Silver/Gold hard gate — genuine data quality violation. Must remain failed.",
    "gold": "Silver/Gold hard gate — genuine data quality violation. Must remain failed.",
    "integration": "Integration E2E reconciliation failure — data pipeline issue. Must remain failed.",
    "bronze": "Bronze detection test found violation above tolerance — documented finding. Must remain failed.",
    "sql": "SQL DQ assertion fired — data violation detected by live SQL query. Must remain failed.",
}
ASSERTION_DEFAULT = "AssertionError — data quality violation. Must remain failed."
INFRA_REASON = "Infrastructure failure — can happen at any layer."
DUCKDB_REASON = "DuckDB engine error — infrastructure/type issue."


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _line_class(line: Column) -> Column:
    """Class found on one line: known names in list order, then a duckdb-style
    ``pkg.ClassException: msg`` candidate, else null."""
    known = None
    for name in KNOWN_EXCEPTION_NAMES:
        hit = F.when(F.instr(line, name) > 0, F.lit(name))
        known = hit if known is None else known.when(F.instr(line, name) > 0, F.lit(name))
    head = F.trim(F.substring_index(F.trim(line), ":", 1))
    candidate = F.trim(F.substring_index(head, ".", -1))
    duck = F.when((F.instr(F.lower(line), "duckdb") > 0) & (F.instr(line, "Exception") > 0) & (candidate != ""), candidate)
    return known.otherwise(duck)


def extract_error_class(text: Column) -> Column:
    classes = F.filter(F.transform(_lines(text), _line_class), lambda c: c.isNotNull())
    return F.coalesce(F.get(classes, 0), F.lit("UnknownError"))


def extract_error_message(text: Column) -> Column:
    """First pytest ``E`` line (``E`` prefix and spaces removed), else the last non-blank line."""
    stripped = F.transform(_lines(text), lambda l: F.regexp_replace(l, r"^\s+|\s+$", ""))
    e_lines = F.filter(stripped, lambda l: l.startswith("E "))
    first_e = F.get(e_lines, 0)
    non_blank = F.filter(stripped, lambda l: l != "")
    last = F.get(non_blank, F.size(non_blank) - 1)
    msg = F.regexp_replace(F.regexp_replace(first_e, r"^E+", ""), r"^\s+|\s+$", "")
    return F.coalesce(msg, last, F.lit(""))


def infer_layer(node_id: Column, keywords: Column) -> Column:
    """First keyword naming a layer, else the first layer (fixed priority) whose
    folder appears in the node id, else ``unknown``."""
    kws = F.split(F.coalesce(keywords, F.lit("")), ",")
    from_kw = F.get(F.filter(kws, lambda k: k.isin(*LAYERS)), 0)
    from_path = None
    for layer in LAYERS:
        cond = (F.instr(node_id, f"/{layer}/") > 0) | (F.instr(node_id, f"tests/{layer}") > 0)
        from_path = F.when(cond, F.lit(layer)) if from_path is None else from_path.when(cond, F.lit(layer))
    return F.coalesce(from_kw, from_path.otherwise(F.lit("unknown")))


def classify(outcome: Column, error_class: Column, layer: Column) -> tuple[Column, Column]:
    """(decision, reason) ladder of the triage tool."""
    assertion_reason = F.coalesce(
        F.element_at(F.create_map(*[x for k, v in ASSERTION_REASONS.items() for x in (F.lit(k), F.lit(v))]), layer),
        F.lit(ASSERTION_DEFAULT),
    )
    decision = (F.when(outcome == "passed", F.lit("pass"))
                .when(error_class.isin(*INFRA_ERRORS), F.lit("healable"))
                .when(error_class == "AssertionError", F.lit("must_fail"))
                .otherwise(F.lit("healable")))
    reason = (F.when(outcome == "passed", F.lit(""))
              .when(error_class.isin(*INFRA_ERRORS), F.lit(INFRA_REASON))
              .when(error_class == "AssertionError", assertion_reason)
              .when(F.instr(F.lower(error_class), "duckdb") > 0, F.lit(DUCKDB_REASON))
              .otherwise(F.concat(error_class, F.lit(" is an infrastructure-class error."))))
    return decision, reason


def triage(runs: DataFrame) -> DataFrame:
    """Per run: layer, error_class, error_message, decision, reason."""
    failed = F.col("outcome") != "passed"
    ec = F.when(failed, extract_error_class(F.col("longrepr"))).otherwise(F.lit(""))
    msg = F.when(failed, extract_error_message(F.col("longrepr"))).otherwise(F.lit(""))
    staged = runs.select("run_id", "node_id", "outcome", infer_layer(F.col("node_id"), F.col("keywords")).alias("layer"),
                         ec.alias("error_class"), msg.alias("error_message"))
    decision, reason = classify(F.col("outcome"), F.col("error_class"), F.col("layer"))
    return staged.select("*", decision.alias("decision"), reason.alias("reason"))


def result_totals(triaged: DataFrame) -> DataFrame:
    """Totals per decision."""
    return triaged.groupBy("decision").agg(F.count(F.lit(1)).alias("n_runs"))


def report_totals(triaged: DataFrame) -> DataFrame:
    """Runs per layer and decision, per layer, and over all (the JSON summary's ``totals``): a null layer or decision
    stands for all of them."""
    totals = triaged.rollup("layer", "decision").agg(F.count(F.lit(1)).alias("n_runs"), F.grouping_id().alias("level"))
    return totals.where("level < 3 OR n_runs > 0").select("layer", "decision", "n_runs")


def run_records(triaged: DataFrame) -> DataFrame:
    """One nested record per run (the JSON summary's ``tests``): what ran, how it ended, and how it was classified."""
    return triaged.select("run_id", F.struct("node_id", "layer", "outcome").alias("test"),
                          F.struct("decision", "reason", F.struct(F.col("error_class").alias("class"), F.col("error_message").alias("message")).alias("error")).alias("classification"))
