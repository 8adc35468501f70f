"""Streaming over rows that are sorted by a key."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sorted_groups(batches, keys: int) -> Iterator[pa.Table]:
    """Tables of the rows that agree in the first *keys* columns, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = [np.asarray(batch.column(i)) for i in range(keys)]
        cuts = [0, *(np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in ids])) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            this = tuple(x[begin] for x in ids)
            if this != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            last = this
    if held:
        yield pa.Table.from_batches(held)
