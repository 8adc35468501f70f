"""Order-preserving packing of documents into sequences, by dynamic programming.

The documents of an input partition form one stream of tokens in stored order;
sequences are consecutive windows of the stream.  Window cuts may fall at
document ends (free), at sentence ends (`SENTENCE_PENALTY` tokens) or elsewhere
(`HARD_PENALTY`): whole sequences after the end of a document of `GRID` tokens or
more, `CHAIN` times, and every `GRID` tokens in a longer gap without a cut.  The
cuts minimise padding plus penalties:

    f(j) = penalty(j) + capacity - position(j) + min { f(i) + position(i) : position(j) - position(i) <= capacity }

The minimum runs over a sliding window of cuts, which a monotone queue keeps,
so a stream of n cuts takes O(n) steps.  The stream is decided in stretches of
`STRETCH` sequences: all but the open end of a stretch is emitted and the rest
carried on, so memory is bounded by a stretch and the longest document.  In the
last stretch of a partition a sequence may also have the length of a power of
two, which is not padded, at `HARD_PENALTY` each.

Documents are never moved between partitions, so nothing is shuffled; a lost
task recomputes the same sequences.  Null and empty texts are one end token.
Repeated ids are documents of their own.  Extra columns are ignored.  An empty
table gives no rows.
"""
from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.rows import released
from tollgate.llm.vocabulary import WordIds

CAPACITY = 2048
END_ID = 1
SENTENCE_PENALTY = 1
HARD_PENALTY = 8
GRID = 64
CHAIN = 8
STRETCH = 48
_SEQUENCES = 1 << 36  # sequence ids of a partition

_PIECES = pa.schema([("doc", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                     ("sequence_id", pa.int64()), ("offset", pa.int64())])


def choose_cuts(position: np.ndarray, penalty: np.ndarray, capacity: int, last: bool) -> list[int]:
    """Positions of the cuts of a stretch that starts at 0; *position* is increasing, its gaps at most *capacity*.
    The end must be a cut if *last*; else the chain ends where it is cheapest within the last window."""
    at, cost = [0, *position.tolist()], [0]
    back = [0]
    index = {p: i for i, p in enumerate(at)} if last else {}
    powers = [1 << k for k in range(capacity.bit_length()) if 1 << k < capacity] if last else []
    queue = deque([0])  # cut indices of increasing f + position
    for j, extra in enumerate(penalty.tolist(), 1):
        here = at[j]
        while at[queue[0]] < here - capacity:
            queue.popleft()
        i = queue[0]
        value = cost[i] + at[i] + capacity - here + extra
        for power in powers:
            k = index.get(here - power)
            if k is not None and cost[k] + HARD_PENALTY + extra < value:
                i, value = k, cost[k] + HARD_PENALTY + extra
        cost.append(value)
        back.append(i)
        value += here
        while queue and cost[queue[-1]] + at[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    j = len(at) - 1
    if not last:
        j = min((k for k in range(1, len(at)) if at[k] > at[-1] - capacity), key=lambda k: (cost[k], -k))
    cuts = []
    while j:
        cuts.append(at[j])
        j = back[j]
    return cuts[::-1]


def power_steps(length: int) -> list[int]:
    """Offsets that cut *length* into powers of two, the largest first."""
    out = []
    while length & (length - 1):
        top = 1 << (length.bit_length() - 1)
        out.append((out[-1] if out else 0) + top)
        length -= top
    return out


class _Stream:
    """The open documents of a partition; hands out pieces once the cuts of a stretch are decided."""

    def __init__(self, sentence_end: np.ndarray, capacity: int, first: int):
        self.sentence_end, self.capacity, self.sequence = sentence_end, capacity, first
        self.docs: deque = deque()  # (id, ids, tokens before the stream)
        self.size = 0

    def add(self, doc, ids: np.ndarray):
        self.docs.append((doc, ids, 0))
        self.size += len(ids)

    def cuts(self, last: bool) -> list[int]:
        places, costs, at = [], [], 0
        for _, ids, used in self.docs:
            ends = np.flatnonzero(self.sentence_end[ids[used:-1]]) + 1
            places += [ends + at, [at + len(ids) - used]]
            costs += [np.full(len(ends), SENTENCE_PENALTY), [0]]
            at += len(ids) - used
        place, cost = np.concatenate(places), np.concatenate(costs)
        keep = np.r_[place[1:] != place[:-1], True]  # a sentence end at a document's end is the latter
        place, cost = place[keep], cost[keep]
        ends = place[cost == 0]
        origin = np.r_[0, ends[np.diff(ends, prepend=0) >= GRID]]
        times = CHAIN if not last else place[-1] // self.capacity
        full = (origin[:, None] + self.capacity * np.arange(1, times + 1)).ravel()
        gaps = np.diff(place, prepend=0)
        grid = [np.arange(place[k] - gaps[k] + GRID, place[k], GRID) for k in np.flatnonzero(gaps > GRID)]
        if last:
            rests = {int(r) for r in (place[-1] - origin) % self.capacity}
            grid += [place[-1] - r + np.array(power_steps(r), np.int64) for r in rests]
        hard = np.setdiff1d(np.concatenate([full, *grid]), place)
        hard = hard[hard < place[-1]]
        order = np.argsort(np.r_[place, hard], kind="stable")
        place, cost = np.r_[place, hard][order], np.r_[cost, np.full(len(hard), HARD_PENALTY)][order]
        return choose_cuts(place, cost, self.capacity, last)

    def pieces(self, last: bool):
        begin = 0
        for cut in self.cuts(last) if self.docs else []:
            offset, need = 0, cut - begin
            while need:
                doc, ids, used = self.docs[0]
                take = min(need, len(ids) - used)
                yield doc, used, ids[used : used + take].astype("<u4").tobytes(), len(ids), self.sequence, offset
                offset, need = offset + take, need - take
                if used + take == len(ids):
                    self.docs.popleft()
                else:
                    self.docs[0] = (doc, ids, used + take)
            self.size -= cut - begin
            begin, self.sequence = cut, self.sequence + 1


def _pack(vocabulary: str, capacity: int, end_id: int):
    def rows(pieces):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*pieces, strict=True), _PIECES, strict=True)], schema=_PIECES)

    def run(batches):
        words = WordIds(vocabulary)
        end = np.array([end_id], "<u4").tobytes()
        stream = _Stream(words.sentence_end, capacity, TaskContext.get().partitionId() * _SEQUENCES)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                stream.add(doc, np.frombuffer(words.ids(text.as_py()) + end, "<u4"))
                if stream.size >= STRETCH * capacity:
                    yield rows(list(stream.pieces(last=False)))
        if stream.docs:
            yield rows(list(stream.pieces(last=True)))

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str = "word_bpe_49k.json",
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document: the id, start and length within its document, ids (binary, little-endian
    unsigned 32-bit), doc_tokens, sequence_id and the offset in that sequence.  Ids of a sequence, by offset, are
    gapless from 0 and at most *capacity*; *end_id* ends each document."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("body"))
    out = texts.mapInArrow(released(_pack(vocabulary, capacity, end_id)),
                           "doc long, start long, ids binary, doc_tokens long, sequence_id long, offset long")
    return out.select(F.col("doc").alias(id_col), "start", (F.length("ids") / 4).cast("long").alias("length"), "ids", "doc_tokens",
                      "sequence_id", "offset")
