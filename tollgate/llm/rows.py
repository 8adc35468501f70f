"""Functions over batches of rows: what a Python worker holds of them, during a task and after it."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def released(run: Callable) -> Callable:
    """*run*, a generator over batches, which gives Arrow's free memory back to the system when it ends: a worker that
    waits for its next task would keep a batch of long texts or more."""

    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return whole


def keep_rows(rows: DataFrame, column: str, judge: Callable) -> DataFrame:
    """The rows of *rows* (all columns) whose *column* is judged true.  *judge*, called once a task, returns a function of
    an Arrow array that gives a boolean a value.  Only the column goes to Python and only booleans come back: the other
    columns, long texts too, never leave Spark's own memory."""

    def judged(arrays):
        keep = judge()
        for values in arrays:
            yield pa.array(keep(values), pa.bool_())

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from released(judged)(arrays)

    return rows.where(F.arrow_udf(run, "boolean")(rows[column]))
