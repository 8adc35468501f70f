from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_path


class MissingColumn(ValueError):
    """A check was pointed at a column the table does not have."""


def require(df: DataFrame, *cols: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumn(f"Column(s) {missing} not found in DataFrame")


def keys_of(key_cols: str | Sequence[str] | None) -> list[str]:
    if key_cols is None:
        return []
    return [key_cols] if isinstance(key_cols, str) else list(key_cols)


def flag_rows(df: DataFrame, key_cols, flags: list[tuple[str, Column, Column]], names=("column_name", "value")) -> DataFrame:
    """One scan, many per-row conditions: emit one row per (row, firing flag).

    ``flags`` holds (label, condition, value).  The conditions become an array
    of nullable structs which is exploded and filtered — the table is read once
    whatever the number of flags.
    """
    keys = keys_of(key_cols)
    label, val = names
    if not flags:  # nothing to check: an empty result with the usual columns
        return df.select(*keys, F.lit(None).cast("string").alias(label), F.lit(None).cast("string").alias(val)).filter(F.lit(False))
    arr = F.array(
        *[
            F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(lab).alias(label), value.cast("string").alias(val)))
            for lab, cond, value in flags
        ]
    )
    exploded = df.select(*keys, F.explode(arr).alias("__f"))
    return exploded.filter(F.col("__f").isNotNull()).select(*keys, f"__f.{label}", f"__f.{val}")


def written(df: DataFrame, name: str) -> DataFrame:
    """*df* written to a folder of its own in the shared folder and read back: computed once, lineage cut."""
    path = shared_path(df.sparkSession, "steps", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
