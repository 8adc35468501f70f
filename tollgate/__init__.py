"""tollgate — data-quality gates for layered (bronze → silver → gold) Spark pipelines.

Every check is a DataFrame → DataFrame function.  Column-level checks of one
table fuse into a single aggregation pass (``run_suite``); cross-table checks
are joins (anti / semi / left, salted for hot keys).  Violations are lazy,
key-identified DataFrames; verdicts are one-row-per-check result tables that
gate promotion (``run_gate``).
"""

from .operators.transform import Promotion, build_gold, promote, promote_parts, promote_suppliers, promote_work_orders
from .plans.expectations import SUITES
from .plans.suite import Check, gate_verdict, run_gate, run_suite, unexpected_rows

__all__ = [
    "Check", "Promotion", "SUITES", "build_gold", "gate_verdict", "promote", "promote_parts", "promote_suppliers",
    "promote_work_orders", "run_gate", "run_suite", "unexpected_rows",
]
