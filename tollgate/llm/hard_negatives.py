"""Hard negatives by segment summaries: integer inner products, bounded before they are computed.

Each component becomes floor(`SCALE` * x).  A vector is cut into segments; for each
its sum and its deviation (the norm of what is left when the mean is taken off) are
stored.  For a segment of m components the inner product is the product of the sums
over m, plus or minus at most the product of the deviations, so the segments' sums
bound a score from both sides.  Bounds start with one segment and are refined by
halving segments, down to `FINEST` components; rows and anchors that no bound keeps
together leave at each step, and only what is left is scored exactly.  A step that
dropped nothing is passed over for the next `REST` blocks of rows.

Anchors are a stated set of rows, searched against all rows in tiles: blocks of
anchors by slices of rows, each tile streamed by one task with the best rows of each
anchor so far, whose least score is the bound to beat.  Rows come in the order of
their ids, so ties need no more than that.  The first search finds an anchor's
positives, the best rows of its own label; the second, for each positive, the best
rows of other labels in the window from `SHARE` to 100 % of the positive's score.
Each tile returns a bounded list for an anchor; a window over those picks the best.
Slices follow the number of rows and, in small tables, of shuffle partitions; a tile
holds its anchors and one block of rows, however many share a label or a vector.

Rows with a null id, label or vector or with a null or non-finite component take no
part, nor do rows whose squared norm reaches 2^62, whose scores need not fit 64 bits.
Only vectors of one length are compared.  Of rows that share an id, the least by label,
length and stored vector counts.  Ties go to the smaller id.  A positive of negative score has an
empty window.  Extra columns are ignored; an empty table gives no rows.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.storage import settle

SCALE = 256
SHARE = 80
POSITIVES = 5
NEGATIVES = 5
FINEST = 4
REST = 8
BLOCK_BYTES = 1 << 26  # of the anchors that a task holds
ROWS_A_SLICE = 1 << 20
LEAST_SLICE = 1 << 12
_STEP = 2048  # rows compared at a time, after a few smaller steps
_WIDE = 256  # anchors compared at a time
_NONE = np.iinfo(np.int64).min


def segment_counts(size: int) -> list[int]:
    """How many segments each step of refinement has, for vectors of so many components."""
    return [1 << k for k in range(max(size // FINEST, 1).bit_length())] if size else []


class Summaries:
    """Of each vector, per step: sums over the segments' roots of length, and deviations."""

    def __init__(self, sums: np.ndarray, squares: np.ndarray, size: int):
        """*sums* and *squares*: of the components of the finest segments, a row for each vector."""
        self.steps = {}
        finest = sums.shape[1]
        edges = np.arange(finest + 1) * size // finest
        for count in segment_counts(size):
            at = np.arange(count) * (finest // count)
            m = np.diff(np.append(edges[at], size))
            s, q = np.add.reduceat(sums, at, axis=1), np.add.reduceat(squares, at, axis=1)
            self.steps[count] = s / np.sqrt(m), np.sqrt(np.maximum(q - s * s / m, 0))


def finest_sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of components and of their squares in the finest segments."""
    size = x.shape[1]
    at = np.arange(n := segment_counts(size)[-1]) * size // n
    return np.add.reduceat(x, at, axis=1), np.add.reduceat(x * x, at, axis=1)


def _coded(batches):
    """(id, label, size, body, sums): the vector as 64-bit integers and its finest sums and squares as doubles, in binary;
    vectors with a null or non-finite component or too large a norm are left out."""
    for batch in batches:
        lists = batch.column(2)
        value, offset = np.asarray(lists.flatten().cast(pa.float64()).fill_null(math.nan)), np.asarray(lists.offsets)
        size, offset = np.diff(offset), offset - offset[0]
        for n in np.unique(size).tolist():
            rows = np.flatnonzero(size == n)
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(SCALE * value[offset[rows][:, None] + np.arange(n)])
                fits = (x * x).sum(axis=1) < 2.0**62  # false for nan
            x, rows = x[fits], rows[fits]
            sums = np.concatenate(finest_sums(x), axis=1) if n else x
            part = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.full(len(rows), n, np.int32)), pa.array([r.tobytes() for r in x.astype("<i8")], pa.binary()),
                                              pa.array([r.tobytes() for r in sums.astype("<f8")], pa.binary())], schema=_CODED)


_CODED = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("size", pa.int32()), ("body", pa.binary()), ("sums", pa.binary())])
_FOUND = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])


class _Vectors:
    """Rows of one length as arrays."""

    def __init__(self, ids, labels, size: int, bodies: list[bytes], sums: list[bytes]):
        self.ids, self.labels, self.size = ids, labels, size
        self.whole = np.frombuffer(b"".join(bodies), "<i8").reshape(len(ids), size)
        self.real = self.whole.astype(float)
        self.norm = np.sqrt((self.real * self.real).sum(axis=1))
        both = np.frombuffer(b"".join(sums), "<f8").reshape(len(ids), -1)
        half = both.shape[1] // 2
        self.steps = Summaries(both[:, :half], both[:, half:], size).steps if size else {}

    def of(self, spot) -> "_Vectors":
        out = object.__new__(_Vectors)
        out.ids, out.labels, out.size = self.ids[spot], self.labels[spot], self.size
        out.whole, out.real, out.norm = self.whole[spot], self.real[spot], self.norm[spot]
        out.steps = {k: (s[spot], d[spot]) for k, (s, d) in self.steps.items()}
        return out


class Tile:
    """Anchors with the best rows so far of each of their windows, fed with rows by increasing id."""

    def __init__(self, anchors: _Vectors, low: np.ndarray, high: np.ndarray, best: int, same_label: bool):
        """*low*, *high*: the least and the greatest score of each anchor's windows (anchors x windows)."""
        self.anchors, self.low, self.high, self.best, self.same = anchors, low.copy(), high, best, same_label
        self.score = np.full((*low.shape, best), _NONE)
        self.id = np.zeros((*low.shape, best), np.int64)
        self.idle: dict[int, int] = {}
        self.scored = 0

    def feed(self, rows: _Vectors) -> None:
        for begin in range(0, len(self.anchors.ids), _WIDE):
            part = np.arange(begin, min(begin + _WIDE, len(self.anchors.ids)))
            if self.same:
                for label in np.intersect1d(self.anchors.labels[part], rows.labels):
                    self._compare(rows.of(rows.labels == label), part[self.anchors.labels[part] == label])
            else:
                self._compare(rows, part)

    def _compare(self, rows: _Vectors, part: np.ndarray) -> None:
        r, a = np.arange(len(rows.ids)), part
        least, most = self.low[part].min(axis=1), self.high[part].max(axis=1)
        a, least, most = a[least <= most], least[least <= most], most[least <= most]
        for count, (s, d) in rows.steps.items():
            if not len(r) or not len(a):
                return
            if self.idle.get(count, 0) > 0:
                self.idle[count] -= 1
                continue
            middle, reach = s[r] @ self.anchors.steps[count][0][a].T, d[r] @ self.anchors.steps[count][1][a].T
            reach += 1e-9 * np.outer(rows.norm[r], self.anchors.norm[a]) + 0.01  # rounding
            alive = (middle + reach >= least) & (middle - reach <= most)
            of_rows, of_anchors = alive.any(axis=1), alive.any(axis=0)
            if of_rows.all() and of_anchors.all():
                self.idle[count] = REST
            r, a, least, most = r[of_rows], a[of_anchors], least[of_anchors], most[of_anchors]
        if not len(r) or not len(a):
            return
        self.scored += len(r) * len(a)
        if rows.norm[r].max() * self.anchors.norm[a].max() < 2.0**52:
            score = (rows.real[r] @ self.anchors.real[a].T).astype(np.int64)
        else:
            score = rows.whole[r] @ self.anchors.whole[a].T
        fits = (score >= least) & (score <= most)
        if self.same:
            fits &= rows.ids[r][:, None] != self.anchors.ids[a]
        else:
            fits &= rows.labels[r][:, None] != self.anchors.labels[a]
        i, j = np.nonzero(fits)
        if len(i):
            self._take(a[j], score[i, j], rows.ids[r][i])

    def _take(self, anchor: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        """Add pairs to the windows that they fall in; the ids are above all earlier ones."""
        for w in range(self.low.shape[1]):
            hit = (score >= self.low[anchor, w]) & (score <= self.high[anchor, w])
            if not hit.any():
                continue
            who = np.unique(anchor[hit])
            owner = np.concatenate([np.repeat(who, self.best), anchor[hit]])
            value = np.concatenate([self.score[who, w].ravel(), score[hit]])
            ids = np.concatenate([self.id[who, w].ravel(), row[hit]])
            order = np.lexsort((ids, -np.maximum(value, _NONE + 1), value == _NONE, owner))
            owner = owner[order]
            first = np.searchsorted(owner, who)[:, None] + np.arange(self.best)
            self.score[who, w], self.id[who, w] = value[order][first], ids[order][first]
            last = self.score[who, w, -1]
            self.low[who, w] = np.where(last == _NONE, self.low[who, w], np.maximum(self.low[who, w], last + 1))

    def found(self) -> pa.RecordBatch:
        anchor, slot, k = np.nonzero(self.score != _NONE)
        return pa.RecordBatch.from_arrays([pa.array(self.anchors.ids[anchor]), pa.array(slot.astype(np.int32)), pa.array(self.score[anchor, slot, k]),
                                           pa.array(self.id[anchor, slot, k])], schema=_FOUND)


def windows(positive: np.ndarray, share: int = SHARE) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest scores from *share* to 100 percent of positive scores (`_NONE`: no positive); empty below 0."""
    whole = np.maximum(positive, 0)
    low = -(-(whole % 100) * share // 100) + whole // 100 * share
    return np.where(positive < 0, np.iinfo(np.int64).max, low), np.where(positive < 0, _NONE, whole)


def _search(slots: int, best: int, same_label: bool, share: int):
    """mapInArrow over rows sorted by (size, tile, is_row, id): the anchors of a tile, then its rows."""

    def vectors(batch: pa.RecordBatch) -> _Vectors:
        return _Vectors(np.asarray(batch.column("id")), np.asarray(batch.column("label")), batch.column("size")[0].as_py(),
                        batch.column("body").to_pylist(), batch.column("sums").to_pylist())

    def open_tile(held: list[pa.RecordBatch]) -> Tile:
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        if same_label:
            low, high = np.full((batch.num_rows, 1), _NONE + 1), np.full((batch.num_rows, 1), np.iinfo(np.int64).max)
        else:
            scores = np.full((batch.num_rows, slots), _NONE)
            for k, x in enumerate(batch.column("wanted").to_pylist()):
                scores[k, : len(x)] = x
            low, high = windows(scores, share)
        return Tile(vectors(batch), low, high, best, same_label)

    def run(batches):
        now, held, tile, step = None, [], None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = [np.asarray(batch.column(c)) for c in ("size", "tile", "is_row")]
            cuts = np.flatnonzero(np.logical_or.reduce([np.diff(x, prepend=x[0]) != 0 for x in marks]))
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                here, is_row = (int(marks[0][begin]), int(marks[1][begin])), bool(marks[2][begin])
                if here != now:
                    if tile:
                        yield tile.found()
                    now, held, tile, step = here, [], None, 64
                part = batch.slice(begin, end - begin)
                if not is_row:
                    held.append(part)
                    continue
                if held:
                    tile, held = open_tile(held), []
                at = 0
                while tile and at < part.num_rows:
                    tile.feed(vectors(part.slice(at, step)))
                    at, step = at + step, min(2 * step, _STEP)
        if tile:
            yield tile.found()

    return run


def _tiled(anchors: DataFrame, rows: DataFrame, blocks: int, slices: int) -> DataFrame:
    """Anchors once for each slice of rows, rows once for each block of anchors, dealt to tiles and sorted there."""
    block, piece = (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(n)).cast("int") for i, n in ((0, blocks), (1, slices)))
    of_anchors = anchors.withColumn("block", block).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).withColumn("is_row", F.lit(False))
    of_rows = (rows.withColumn("slice", piece).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("is_row", F.lit(True))
               .withColumn("wanted", F.lit(None).cast("array<long>")))
    both = of_anchors.unionByName(of_rows).withColumn("tile", F.col("block") * F.lit(slices).cast("long") + F.col("slice")).drop("block", "slice")
    return both.repartitionById(blocks * slices, F.col("tile").cast("int")).sortWithinPartitions("size", "tile", "is_row", "id")


def _best(found: DataFrame, by: list[str], best: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *,
         positives: int = POSITIVES, negatives: int = NEGATIVES, share: int = SHARE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor (rows of *vectors* where
    *is_anchor* holds, over the column ``id``) and each of its first *positives* other rows of the same label, the first
    *negatives* rows of another label whose score is *share* to 100 percent of the positive's.  Labels are integers."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").mapInArrow(
        _coded, "id long, label long, size int, body binary, sums binary")
    rows = settle(rows.groupBy("id").agg(F.min(F.struct("label", "size", "body", "sums")).alias("v")).select("id", "v.*"), "vectors")
    anchors = rows.where(is_anchor)
    count = rows.agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("a"), F.coalesce(F.max("size"), F.lit(0)).alias("size")).first()
    blocks = max(1, math.ceil(count.a * (32 * count.size + 32 * positives * negatives) / BLOCK_BYTES))
    tasks = math.ceil(int(spark.conf.get("spark.sql.shuffle.partitions")) / blocks)
    slices = max(1, math.ceil(count.n / ROWS_A_SLICE), min(tasks, math.ceil(count.n / LEAST_SLICE)))
    schema = "anchor long, slot int, score long, id long"

    first = _tiled(anchors.withColumn("wanted", F.lit(None).cast("array<long>")), rows, blocks, slices)
    first = first.mapInArrow(_search(1, positives, True, share), schema)
    near = settle(_best(first, ["anchor"], positives).select("anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"),
                                                            F.col("score").alias("positive_score")), "positives")
    wanted = near.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "positive_score"))),
                                                    lambda x: x.positive_score).alias("wanted"))
    second = _tiled(anchors.join(wanted, anchors["id"] == wanted["anchor"]).drop("anchor"), rows, blocks, slices)
    second = second.mapInArrow(_search(positives, negatives, False, share), schema)
    return (_best(second, ["anchor", "slot"], negatives).join(near, ["anchor", "slot"])
            .select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
