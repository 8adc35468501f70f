"""Vector best-fit packing of documents into as few sequences as possible.

A sequence has three capacities: tokens, documents (pieces) and attention cost
(the sum of the squared lengths of its pieces).  A document is its token ids and
an end id; one that is longer than a piece may be is cut into pieces of that
length, the first of which may be shorter.  Pieces that fill a sequence alone are
one; the others are placed by decreasing length, each into the sequence that can
still take it under every constraint and whose residual capacities, after it, have
the least weighted norm (equal norms: the one opened first); if none can, a new
sequence is opened.  A sequence that wins with a length also wins the next piece of
that length, since its norm only falls, so all pieces of one length are placed
together: one pass over the open sequences for each distinct length.

Pieces are written once with a key of each row.  Their lengths, not their ids, are
then dealt by key into groups of about `GROUP`, each packed by one task, so at most
a few sequences a group are part empty, whatever the table's size or the skew of
its ids and sources.  Sequence ids carry the group; a lost task makes them again.

Null and empty texts are one end token.  Repeated ids are documents of their own,
null ids stay null.  Ties in length keep the order of the keys.  Extra columns are
ignored.  An empty table gives no rows.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.byte_ids import byte_ids
from tollgate.llm.storage import settle

CAPACITY = 2048
END_ID = 0
GROUP = 1 << 16
#: Weights of the squared residual shares of tokens, documents and attention cost.
WEIGHTS = (1.0, 0.01, 0.01)
_SEQUENCES = 1 << 36  # sequence ids of a group
_BATCH_BYTES = 1 << 23


def best_fit(length: np.ndarray, tokens: int, documents: int, attention: int, weights=WEIGHTS) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; every piece fits into an empty sequence."""
    sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    order = np.argsort(-length, kind="stable")
    begin = np.flatnonzero(np.diff(length[order], prepend=-1))
    left = np.empty((3, 1024), np.int64)  # residual tokens, documents and attention of the open sequences
    opened = 0
    empty = np.array([tokens, documents, attention], np.int64)[:, None]
    scale = np.sqrt(np.array(weights))[:, None] / empty
    for items in np.split(order, begin[1:]) if len(order) else []:
        size = int(length[items[0]])
        need = np.array([size, 1, size * size], np.int64)[:, None]
        room = (left[:, :opened] // need).min(axis=0)
        able = np.flatnonzero(room > 0)
        if len(able):
            norm = (((left[:, able] - need) * scale) ** 2).sum(axis=0)
            able = able[np.argsort(norm, kind="stable")]
        at = 0
        taken = np.minimum(np.cumsum(room[able]), len(items))
        able = able[: np.searchsorted(taken, len(items)) + 1]
        if len(able):
            each = np.diff(taken[: len(able)], prepend=0)
            at = int(taken[len(able) - 1])
            _put(items[:at], able, each, size, left, tokens, sequence, offset)
        rest = len(items) - at
        if rest:
            most = int((empty // need).min())
            new = -(-rest // most)
            if opened + new > left.shape[1]:
                left = np.hstack([left, np.empty((3, max(left.shape[1], new)), np.int64)])
            left[:, opened : opened + new] = empty
            each = np.full(new, most)
            each[-1] = rest - most * (new - 1)
            _put(items[at:], np.arange(opened, opened + new), each, size, left, tokens, sequence, offset)
            opened += new
    return sequence, offset


def _put(items, bins, each, size, left, tokens, sequence, offset) -> None:
    """Place *items*, all of one *size*, into *bins*, so many in *each*."""
    owner = np.repeat(bins, each)
    nth = np.arange(len(items)) - np.repeat(np.cumsum(each) - each, each)
    sequence[items] = owner
    offset[items] = tokens - left[0, owner] + nth * size
    left[0, bins] -= each * size
    left[1, bins] -= each
    left[2, bins] -= each * size * size


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str = "byte_bpe_50k.json",
           most: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of at most *most* tokens: the id, piece (from 0), start (ids of the document before it) and
    ids (binary, little-endian unsigned 32-bit)."""
    schema = pa.schema([("doc", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("ids", pa.binary())])

    def stack(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches):
        encoder, end = byte_ids(vocabulary), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows, held = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.of(text.as_py()) + end
                first = (len(ids) // 4 - 1) % most + 1
                cuts = [0, *range(4 * first, len(ids) + 1, 4 * most)]
                rows += [(doc, k, b // 4, ids[b:e]) for k, (b, e) in enumerate(zip(cuts, cuts[1:], strict=False))]
                held += len(ids)
                if held >= _BATCH_BYTES:
                    yield stack(rows)
                    rows, held = [], 0
            if rows:
                yield stack(rows)

    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("body"))
    return texts.mapInArrow(run, "doc long, piece int, start long, ids binary").withColumnRenamed("doc", id_col)


def place(rows: DataFrame, *, capacity: int = CAPACITY, documents: int | None = None, attention: int | None = None, weights=WEIGHTS,
          group: int = GROUP) -> DataFrame:
    """*rows* with sequence_id and offset.  They hold a column ``length`` (1 to *capacity*) and a column ``key`` that
    tells them apart, and are read from a table.  A sequence takes at most *documents* rows and *attention* cost;
    by default neither binds (a sequence of *capacity* rows, or one row of that length, is allowed)."""
    documents, attention = documents or capacity, attention or capacity * capacity
    schema = T.StructType([*rows.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    alone = F.col("length") >= capacity
    open_rows = rows.where(~alone)
    groups = max(1, math.ceil(open_rows.count() / group))
    at = rows.columns.index("length")

    def run(batches):
        table = [b for b in batches if b.num_rows]
        if not table:
            return
        table = pa.Table.from_batches(table)
        found = best_fit(np.asarray(table.column(at)).astype(np.int64), capacity, documents, attention, weights)
        first = TaskContext.get().partitionId() * _SEQUENCES
        table = table.append_column("sequence_id", pa.array(found[0] + first)).append_column("offset", pa.array(found[1]))
        yield from table.to_batches()

    packed = open_rows.repartition(groups, "key").sortWithinPartitions("key").mapInArrow(run, schema)
    whole = rows.where(alone).withColumn("sequence_id", -1 - F.col("key")).withColumn("offset", F.lit(0).cast("long"))
    return packed.union(whole)


def keyed(rows: DataFrame) -> DataFrame:
    """*rows* written with a key of each, so that it stays the same whenever a task is run again."""
    return settle(rows.withColumn("key", F.monotonically_increasing_id()), "pieces")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str = "byte_bpe_50k.json", capacity: int = CAPACITY,
         documents: int | None = None, attention: int | None = None, weights=WEIGHTS, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document: the id, piece, start, length, ids, sequence_id and the offset in that sequence.
    Rows of a sequence, by offset, are gapless from 0.  Pieces are short enough for *attention*."""
    most = min(capacity, math.isqrt(attention)) if attention else capacity
    rows = keyed(pieces(docs, id_col, text_col, vocabulary=vocabulary, most=most, end_id=end_id)
                 .withColumn("length", (F.octet_length("ids") / 4).cast("long")))
    placed = place(rows.select("key", "length"), capacity=capacity, documents=documents, attention=attention, weights=weights)
    return rows.join(placed.drop("length"), "key").select(id_col, "piece", "start", "length", "ids", "sequence_id", "offset")
