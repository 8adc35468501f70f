"""A Bloom filter of fixed size over 64-bit values: whatever the table, the driver and a broadcast hold `BITS` / 8
bytes.  It only says which rows can matter; a full filter lets everything through and changes no result."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.rows import keep_rows
from tollgate.llm.storage import settle
from tollgate.llm.wordhash import U64, mix

BITS = 1 << 24
PROBES = 4


def _spots(values: np.ndarray, bits: int, probe: int) -> np.ndarray:
    return (mix(values.view(U64), 50 + probe) % U64(bits)).view(np.int64)


def bitmap_of(df: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The filter of a column of integers without nulls."""

    def words(batches):
        for batch in batches:
            spot = np.unique(np.concatenate([_spots(np.asarray(batch.column(0)), bits, i) for i in range(PROBES)]))
            yield pa.RecordBatch.from_arrays([pa.array((spot >> 6).astype(np.int32)), pa.array((U64(1) << (spot & 63).astype(U64)).view(np.int64))], names=["w", "b"])

    rows = df.select(F.col(column).cast("long").alias("v")).mapInArrow(words, "w int, b long").groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(bits // 64, np.int64)
    found = rows.toArrow()  # at most bits / 64 rows
    out[np.asarray(found.column("w"))] = np.asarray(found.column("b"))
    return out.view(U64)


def may_hold(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the *values* may be in the filter."""
    left = np.arange(len(values))
    for probe in range(PROBES):  # most values leave at the first
        spot = _spots(values[left], len(bitmap) * 64, probe)
        left = left[(bitmap[spot >> 6] >> (spot & 63).view(U64)) & U64(1) != 0]
    out = np.zeros(len(values), bool)
    out[left] = True
    return out


def without(rows: DataFrame, id_col: str, gone: DataFrame) -> DataFrame:
    """*rows* whose integer id is not in the only column of *gone* (all columns; null ids stay).  Rows that the filter
    clears stay where they are; only the others go through an anti join, so long texts are not shuffled."""
    gone = settle(gone.toDF("_gone").where("_gone IS NOT NULL").distinct(), "gone")
    shared = rows.sparkSession.sparkContext.broadcast(bitmap_of(gone, "_gone"))

    def part(wanted: bool):
        def judge():
            def keep(ids):
                ids = ids.cast(pa.int64())
                return (may_hold(shared.value, np.asarray(ids.fill_null(0))) & np.asarray(ids.is_valid())) == wanted

            return keep

        return keep_rows(rows, id_col, judge)

    doubtful = part(True)
    return part(False).union(doubtful.join(gone, doubtful[id_col] == gone["_gone"], "left_anti"))
