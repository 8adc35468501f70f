"""Aggregate-expression helpers used to fuse many checks into one pass."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_if(cond: Column) -> Column:
    """Rows where ``cond`` is true (null counts as false).  Bigint."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")
