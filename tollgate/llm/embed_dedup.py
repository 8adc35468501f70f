"""Near-duplicate embeddings by random-hyperplane sign hashing.

Equal vectors of a label are one class.  Each class gets, per table, the signs
of its dot products with random hyperplanes; vectors of one label, length and
code meet in a bucket.  The number of bits grows with the logarithm of the number
of classes, and the number of tables is what keeps the chance to meet a pair of
the threshold's cosine at `RECALL` or more; pairs above it meet more often, and
no pair below it is ever linked.

Ids and codes meet first, without vectors.  The signs of all tables are one long
sketch, so a pair's angle shows in the number of signs that differ: pairs that
differ in more than a pair of the threshold's cosine does with a chance of `MISS`
are dropped, as are pairs that have met in an earlier table.  Only vectors that
still have a partner are fetched, and the cosine of what is left is computed in
double precision.

A bucket of more than `TILE` vectors is cut into tiles of about that size and each
pair of tiles is a group of its own, so no bucket is held whole.  A pair is counted
only in the first table that it meets in; a group returns a count for each vector
and a spanning forest of its links, never the pairs.  Components are joined by
distributed star contraction.

Null labels, null, empty or zero vectors and vectors with null or non-finite
components link with nothing; so do vectors of different lengths.  Repeated rows
of one id count once.  A row with a null id links with nothing and has nulls.
Extra columns are ignored; an empty table gives no rows.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.components import components
from tollgate.llm.grouping import sorted_groups
from tollgate.llm.storage import settle

THRESHOLD = 0.93
RECALL = 0.998
MISS = 1e-6
LEAST_BITS = 12
ROWS_A_CODE = 16
TILE = 512
_SEED = 20_240_601


def hash_shape(classes: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for so many vectors."""
    bits = max(LEAST_BITS, math.ceil(math.log2(max(classes, 1) / ROWS_A_CODE)))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log1p(-meet))


def distance_cut(signs: int, threshold: float, miss: float = MISS) -> int:
    """The most of *signs* signs in which a pair of the threshold's cosine differs, but for a chance of *miss*."""
    p = math.acos(threshold) / math.pi
    if p == 0:
        return 0
    upto = 0.0
    for k in range(signs + 1):
        upto += math.exp(math.lgamma(signs + 1) - math.lgamma(k + 1) - math.lgamma(signs - k + 1) + k * math.log(p) + (signs - k) * math.log1p(-p))
        if upto >= 1 - miss:
            return k
    return signs


def _coded(bits: int, tables: int):
    """Adds the code of every table (int64 array) and all signs, packed."""

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            lists = batch.column(2)
            flat, offset = np.asarray(lists.flatten()).astype(float), np.asarray(lists.offsets)
            size = np.diff(offset)
            offset = offset - offset[0]
            codes = np.empty((len(size), tables), np.int64)
            sketch = np.empty((len(size), -(-bits * tables // 8)), np.uint8)
            for n in np.unique(size).tolist():
                if n not in planes:
                    planes[n] = np.random.default_rng([_SEED, n]).standard_normal((n, bits * tables))
                rows = np.flatnonzero(size == n)
                x = flat[offset[rows][:, None] + np.arange(n)]
                signs = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ planes[n] >= 0
                codes[rows] = signs.reshape(len(rows), tables, bits) @ (1 << np.arange(bits))
                sketch[rows] = np.packbits(signs, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(size, pa.int32()),
                                              pa.array(codes.tolist(), pa.list_(pa.int64())), pa.array([x.tobytes() for x in sketch], pa.binary())],
                                             names=["vec", "label", "body", "copies", "size", "code", "signs"])

    return run


class _Pairs:
    """Which rows of a bucket's group can be near."""

    def __init__(self, bits: int, tables: int, threshold: float):
        self.bits, self.tables, self.cut = bits, tables, distance_cut(bits * tables, threshold)

    def __call__(self, signs: list[bytes], table: int, block: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(a, b), a < b: pairs that meet in this table first and differ in few enough signs; of different blocks, if given."""
        x = np.frombuffer(b"".join(signs), np.uint8).reshape(len(signs), -1)
        a, b = [], []
        for k in range(0, len(x), 64):
            near = np.bitwise_count(x[k : k + 64, None] ^ x[None]).sum(axis=2, dtype=np.int32) <= self.cut
            i, j = np.nonzero(near)
            keep = i + k < j
            a.append(i[keep] + k)
            b.append(j[keep])
        a, b = np.concatenate(a), np.concatenate(b)
        if block is not None:
            other = block[a] != block[b]
            a, b = a[other], b[other]
        if len(a):
            used = np.unique(np.r_[a, b])
            signs_of = np.unpackbits(x[used], axis=1, count=self.bits * self.tables).reshape(len(used), self.tables, self.bits)
            code = signs_of[:, : table + 1].astype(np.int64) @ (1 << np.arange(self.bits))
            same = code[np.searchsorted(used, a)] == code[np.searchsorted(used, b)]
            first = same[:, table] & ~same[:, :table].any(axis=1)  # the bucket's key is a hash of the code
            a, b = a[first], b[first]
        return a, b


_MET = pa.schema([("key", pa.int64()), ("vec", pa.int64()), ("no", pa.int32()), ("big", pa.bool_())])


def _meet(pairs: _Pairs):
    """mapInArrow over (key, vec, no, signs) sorted by key: rows of a bucket that have a near partner, and all rows of a bucket
    of more than a tile (big), of which no more than a tile is held."""

    def run(batches):
        out, held, last, passing = [], [], None, False

        def close():
            if len(held) > 1 and not passing:
                a, b = pairs([r[2] for r in held], held[0][1])
                out.extend((last, held[k][0], held[k][1], False) for k in np.unique(np.r_[a, b]).tolist())

        for batch in batches:
            key = np.asarray(batch.column(0))
            vec, no, signs = batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)
            for begin, end in _runs(key):
                if end - begin == 1 and begin and end < len(key):  # alone in its bucket
                    close()
                    held, passing, last = [], False, None
                    continue
                if key[begin] != last:
                    close()
                    held, passing, last = [], False, int(key[begin])
                for at in range(begin, end, TILE + 1):
                    rows = [(vec[k], no[k], signs[k].as_py()) for k in range(at, min(end, at + TILE + 1))]
                    held += rows
                    if passing or len(held) > TILE:
                        out.extend((last, v, t, True) for v, t, _ in held)
                        held, passing = [], True
            if len(out) >= 1 << 14:
                yield _stack(out)
                out.clear()
        close()
        if out:
            yield _stack(out)

    return run


def _runs(key: np.ndarray):
    cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
    return zip(cuts, cuts[1:], strict=False) if len(key) else ()


def _stack(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _MET, strict=True)], schema=_MET)


def _meet_tiles(pairs: _Pairs):
    """As `_meet`, for pairs of tiles: rows of (key, i, j) that have a near partner."""

    def run(batches):
        for t in sorted_groups(batches, 3):
            first, second = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            block = np.asarray(t.column("block")) if first != second else None
            a, b = pairs(t.column("signs").to_pylist(), t.column("no")[0].as_py(), block)
            yield from t.select(["key", "i", "j", "block", "vec", "no"]).take(pa.array(np.unique(np.r_[a, b]))).to_batches()

    return run


def _forest(linked: np.ndarray) -> np.ndarray:
    """The least index that each row of a symmetric link matrix reaches."""
    root = np.arange(len(linked))
    while True:
        new = np.minimum(root, np.where(linked, root[None, :], len(root)).min(axis=1))
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(pairs: _Pairs, threshold: float):
    def run(batches):
        for t in sorted_groups(batches, 3):
            first, second = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            block = np.asarray(t.column("block")) if first != second else None
            vec, copies, label = (np.asarray(t.column(c)) for c in ("vec", "copies", "label"))
            a, b = pairs(t.column("signs").to_pylist(), t.column("no")[0].as_py(), block)
            size = np.asarray(t.column("size"))
            same = (label[a] == label[b]) & (size[a] == size[b])
            a, b = a[same], b[same]
            if not len(a):
                continue
            body = [np.asarray(x.values, float) for x in t.column("body").combine_chunks()]
            norm = np.array([np.sqrt(x @ x) for x in body])
            linked = np.zeros(len(a), bool)
            for n in np.unique(size[a]).tolist():  # one length, but for equal hashes
                here = np.flatnonzero(size[a] == n)
                used = np.unique(np.r_[a[here], b[here]])
                x = np.stack([body[k] for k in used.tolist()])
                for k in range(0, len(here), 1 << 14):
                    part = here[k : k + (1 << 14)]
                    dot = np.einsum("ij,ij->i", x[np.searchsorted(used, a[part])], x[np.searchsorted(used, b[part])])
                    linked[part] = dot / (norm[a[part]] * norm[b[part]]) >= threshold
            if not linked.any():
                continue
            matrix = np.zeros((len(vec), len(vec)), bool)
            matrix[a[linked], b[linked]] = matrix[b[linked], a[linked]] = True
            some = matrix.any(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(vec[some]), pa.array((matrix @ copies)[some], pa.int64()), pa.array(vec[_forest(matrix)][some])],
                                             names=["vec", "links", "root"])

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *,
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per row of *vectors*: the id, n_links (other vectors linked directly), component_id (the least id
    reachable, itself included) and kept (whether that is its own)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec"), F.col(label_col).alias("label"), F.col(vector_col).alias("body"))
    usable = (F.col("vec").isNotNull() & F.col("label").isNotNull() & (F.size("body") > 0)
              & F.forall("body", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("body", lambda v: v != 0))
    usable = F.coalesce(usable, F.lit(False))
    classes = settle(rows.where(usable).groupBy("label", "body").agg(F.min("vec").alias("least"), F.countDistinct("vec").alias("copies")), "vectors")
    bits, tables = hash_shape(classes.count(), threshold, recall)
    kind = dict(classes.dtypes)["body"]
    coded = classes.select(F.col("least").alias("vec"), F.xxhash64("label").alias("label"), "body", "copies").mapInArrow(
        _coded(bits, tables), f"vec long, label long, body {kind}, copies long, size int, code array<long>, signs binary")
    coded = settle(coded, "codes")
    pairs = _Pairs(bits, tables, threshold)
    places = coded.select("vec", "label", "size", "signs", F.posexplode("code").alias("no", "value")).select(
        F.xxhash64("label", "size", "no", "value").alias("key"), "vec", "no", "signs")
    met = settle(places.repartition("key").sortWithinPartitions("key").mapInArrow(_meet(pairs), "key long, vec long, no int, big boolean"), "met")
    big = met.where("big").select("key", "vec", "no")
    tiles = big.groupBy("key").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    tiled = (big.join(settle(tiles, "tiles"), "key").withColumn("block", F.expr("cast(pmod(xxhash64(vec), tiles) as int)"))
             .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
             .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "vec", "no")
             .join(coded.select("vec", "signs"), "vec").select("key", "i", "j", "block", "vec", "no", "signs"))
    tiled = tiled.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(
        _meet_tiles(pairs), "key long, i int, j int, block int, vec long, no int")
    zero = F.lit(0)
    near = met.where("NOT big").select("key", zero.alias("i"), zero.alias("j"), zero.alias("block"), "vec", "no").union(tiled)
    groups = near.join(coded.select("vec", "label", "body", "copies", "size", "signs"), "vec").select(
        "key", "i", "j", "block", "vec", "no", "label", "body", "copies", "size", "signs")
    found = settle(groups.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(
        _compare(pairs, threshold), "vec long, links long, root long"), "links")
    links = found.groupBy("vec").agg(F.sum("links").alias("links"))
    parts = components(found, "vec", "root")
    of_class = (classes.join(links, F.col("least") == F.col("vec"), "left").drop("vec")
                .join(parts, F.col("least") == F.col("node"), "left")
                .select("label", "body", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                        F.coalesce("component", "least").alias("component_id")))
    joined = rows.withColumn("usable", usable)
    out = joined.where("usable").join(of_class, ["label", "body"]).select("vec", "n_links", "component_id").union(
        joined.where("NOT usable").select("vec", F.when(F.col("vec").isNotNull(), F.lit(0).cast("long")), "vec"))
    return out.select(F.col("vec").alias(id_col), "n_links", "component_id", (F.col("vec") == F.col("component_id")).alias("kept"))
