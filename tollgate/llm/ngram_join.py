"""N-gram Jaccard self-join by parity sketches.

Every text is the set of its distinct word shingles.  A *parity sketch* hashes
each shingle to one position of a bit vector and flips that bit; two sketches
differ in at most as many bits as the sets have elements that only one of them
holds, so their Hamming distance is a lower bound of the symmetric difference.
The sketch is used twice, at two widths:

* **Wide, cut into blocks (candidate join).**  For a band of set sizes the
  vector (2^32 bits a block) is cut into a fixed number of blocks, and a block
  is held as a 64-bit linear (XOR) hash of the shingles that flip bits in it.
  Sets with Jaccard >= t differ in at most d = (1-t)/(1+t) * (|A|+|B|)
  elements, hence in at most d blocks; so among the first d+1 non-empty blocks
  of either set, in any common order of blocks, at least one is equal
  (pigeonhole).  Each text emits just those d+1 block hashes, rare ones first
  (blocks with a shingle that is frequent in a sample come last: the order
  changes cost, never results).  A size within reach of the next lower band
  emits for that band too.  Sets with too few non-empty blocks add a prefix of
  their sorted shingles, which is exact by itself.
* **Narrow, 2,048 bits (filter).**  Candidate pairs whose narrow sketches
  differ in more than d bits cannot be similar and are dropped.

What is left is verified on the exact shingle sets.  Groups of equal block
hashes are first linked as stars around their smallest member; then only
members that are still in different components are compared with each other,
sketches first, so that thousands of copies never become all their pairs.
Equal sets are one *class* throughout and cost one candidate.

Null or word-less texts have an empty set and no links; fewer words than the
shingle width count as one shingle; repeated rows of one id are one node.
Extra columns are ignored.  An empty table gives an empty result.

What is broadcast has a fixed size: `HOT_SHINGLES` hashes, `HEAVY_CLASSES`
classes (of more than `HEAVY_COPIES` equal sets; their other members' keys are
left out) and a Bloom filter of 2 MB.  None of the
three changes the result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.bitmap import bitmap_of, may_hold, without
from tollgate.llm.components import components
from tollgate.llm.grouping import sorted_groups
from tollgate.llm.rows import released
from tollgate.llm.storage import keyed_rows, settle
from tollgate.llm.wordhash import U64, mix, shingle_set, word_hashes

WIDTH = 5
THRESHOLD_PCT = 80
SKETCH_BITS = 2048
HOT_SHINGLES = 1 << 18
HOT_SAMPLE = 32  # one text in so many is sampled for frequent shingles
HOT_COUNT = 2
HEAVY_CLASSES = 1 << 17
HEAVY_COPIES = 8
TILE = 512
_ROWS = 1 << 16  # rows of a yielded batch

_S64 = np.int64


def max_difference(a: int, b: int, pct: int) -> int:
    """Most elements that only one of two sets of these sizes holds, at a Jaccard similarity of *pct* / 100."""
    return (100 - pct) * (a + b) // (100 + pct)


def set_fingerprint(shingles: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mix(shingles, 77).sum(dtype=U64).astype(_S64))


def narrow_sketch(shingles: np.ndarray) -> bytes:
    """Bit j is the parity of the number of shingles that hash to j."""
    parity = np.bincount((mix(shingles, 5) >> U64(40)).astype(np.int64) & (SKETCH_BITS - 1), minlength=SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def block_keys(shingles: np.ndarray, hot: tuple[np.ndarray, np.ndarray], pct: int) -> np.ndarray:
    """Block hashes that this set emits; similar sets share at least one.  *hot*: sorted shingles and their counts;
    a block is as frequent as its rarest shingle at most, and the rare ones come first."""
    n = len(shingles)
    if n == 0:
        return np.empty(0, U64)
    reach = n * 100 // pct
    d = max_difference(n, reach, pct)
    count = np.zeros(n, np.int64)
    if len(hot[0]):
        at = np.minimum(np.searchsorted(hot[0], shingles), len(hot[0]) - 1)
        count = np.where(hot[0][at] == shingles, hot[1][at], 0)
    band = n.bit_length() - 1
    out, short = [], False
    for c in {band, band - 1} if band and n * pct <= 100 * ((1 << band) - 1) else {band}:
        k = (1 << c) + 4
        h = mix(shingles, 100 + c)
        block = ((h >> U64(32)) * U64(k)) >> U64(32)
        order = np.argsort(block, kind="stable")
        block = block[order]
        start = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        content = np.bitwise_xor.reduceat(mix(h, 7)[order], start)
        pick = np.argsort(np.minimum.reduceat(count[order], start), kind="stable")[: d + 1]
        out.append(mix(content[pick] ^ mix(block[start][pick], 300 + c)))
        short |= len(start) <= d
    if short:  # both sets of a pair may be short of blocks: a prefix of the sorted shingles
        out.append(mix(shingles[: n - -(-n * pct // 100) + 1], 999))
    return np.concatenate(out)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes | None]]:
    yield from zip(batch.column(0).to_pylist(), batch.column(1), strict=True)


def _mapper(one, schema: pa.Schema, most_rows: int = _ROWS):
    """mapInArrow function: *one*(id, words) yields the columns of some rows; batches are bounded by rows."""

    def run(batches):
        for batch in batches:
            parts, rows = [], 0
            for key, text in _texts(batch):
                got = one(key, word_hashes(text.as_buffer().to_pybytes() if text.is_valid else None))
                if got is None:
                    continue
                parts.append(got)
                rows += len(got[0])
                if rows >= most_rows:
                    yield _stack(parts, schema)
                    parts, rows = [], 0
            if parts:
                yield _stack(parts, schema)

    return run


def _stack(parts, schema: pa.Schema) -> pa.RecordBatch:
    columns = []
    for i, field in enumerate(schema):
        if field.type == pa.binary():
            columns.append(pa.array([x for p in parts for x in p[i]], pa.binary()))
        elif pa.types.is_list(field.type):
            lists = [x for p in parts for x in p[i]]
            offsets = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists))))
        else:
            columns.append(pa.array(np.concatenate([np.asarray(p[i]) for p in parts]).astype(field.type.to_pandas_dtype()), field.type))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


_SETS = pa.schema([("doc", pa.int64()), ("n", pa.int32()), ("fp", pa.int64()), ("sketch", pa.binary()), ("keys", pa.list_(pa.int64()))])
_FULL = pa.schema([("doc", pa.int64()), ("fp", pa.int64()), ("shingles", pa.binary())])
_PAIR = ("a", "afp", "b", "bfp")
_GROUP = pa.schema([("key", pa.int64()), ("pn", pa.int32()), ("pfp", pa.int64()), ("n", pa.int32()), ("fp", pa.int64())])


def _members(batches):
    """Rows sorted by key, equal classes together: for each class of a key but the first, a row with the key's first class.
    Holds one row between batches, whatever the size of a key's group."""
    last = None  # key, pivot n, pivot fp, n, fp of the row before
    for batch in batches:
        if not batch.num_rows:
            continue
        key, n, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        head = np.r_[last is None or last[0] != key[0], key[1:] != key[:-1]]
        same = np.r_[last is not None and not head[0] and (last[3], last[4]) == (n[0], fp[0]),
                     (key[1:] == key[:-1]) & (n[1:] == n[:-1]) & (fp[1:] == fp[:-1])]
        at = np.maximum.accumulate(np.where(head, np.arange(len(key)), -1))
        pn, pfp = n[at], fp[at]
        if not head[0]:
            lead = at < 0
            pn[lead], pfp[lead] = last[1], last[2]
        keep = ~head & ~same & ((n != pn) | (fp != pfp))
        last = (key[-1], pn[-1], pfp[-1], n[-1], fp[-1])
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (key, pn, pfp, n, fp)], schema=_GROUP)


def _sketch_filter(pct: int):
    """Drops pairs whose narrow sketches differ in more bits than similar sets can."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            an, bn = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (4, 5))
            sa, sb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), U64).reshape(len(an), -1) for i in (6, 7))
            apart = np.bitwise_count(sa ^ sb).sum(axis=1, dtype=np.int64)
            yield batch.select(_PAIR).filter(pa.array(apart <= (100 - pct) * (an + bn) // (100 + pct)))

    return run


def _compare_tiles(pct: int):
    """Pairs of one tile (key, i, j) with different labels whose sketches are near enough; rows of tile i and tile j."""

    def run(batches):
        for t in sorted_groups(batches, 3):
            block, n, doc, fp, label = (np.asarray(t.column(c)) for c in ("block", "n", "doc", "fp", "label"))
            first, second = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            if (label == label[0]).all():
                continue
            order = np.argsort(n, kind="stable")
            block, n, doc, fp, label = block[order], n[order].astype(np.int64), doc[order], fp[order], label[order]
            sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), U64).reshape(len(n), -1)[order]
            reach = np.searchsorted(n, n * 100 // pct, "right")
            left, right = [], []
            for a in range(len(n) - 1):
                b = np.arange(a + 1, reach[a])
                b = b[(label[b] != label[a]) & ((block[b] != block[a]) if first != second else True)]
                if len(b):
                    apart = np.bitwise_count(sketch[b] ^ sketch[a]).sum(axis=1, dtype=np.int64)
                    b = b[apart <= (100 - pct) * (n[a] + n[b]) // (100 + pct)]
                    left.append(np.full(len(b), a))
                    right.append(b)
            if left:
                a, b = np.concatenate(left), np.concatenate(right)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[a], fp[a], doc[b], fp[b])], names=list(_PAIR))

    return run


def _exact_filter(pct: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= pct * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class _Join:
    """One run of the self-join over (doc, body): body is the text as bytes."""

    def __init__(self, texts: DataFrame, width: int, pct: int):
        self.texts, self.width, self.pct = texts, width, pct
        self.spark = texts.sparkSession

    def sets(self) -> DataFrame:
        """Size, fingerprint, narrow sketch and block keys of every text, in one pass over the texts."""
        width, pct = self.width, self.pct
        hot = self.spark.sparkContext.broadcast(self.hot_shingles())

        def one(doc, words):
            s = shingle_set(words, width)
            return [doc], [len(s)], [set_fingerprint(s)], [narrow_sketch(s)], [block_keys(s, hot.value, pct).view(_S64)]

        return self.texts.mapInArrow(released(_mapper(one, _SETS, 1 << 12)), "doc long, n int, fp long, sketch binary, keys array<long>")

    def hot_shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """Shingles frequent in a fixed share of the texts, with counts; at most HOT_SHINGLES reach the driver."""
        width = self.width

        def one(_, words):
            return (shingle_set(words, width).view(_S64),)

        sample = self.texts.where(F.expr(f"pmod(xxhash64(doc), {HOT_SAMPLE})") == 0)
        counts = sample.mapInArrow(released(_mapper(one, pa.schema([("h", pa.int64())]))), "h long").groupBy("h").count()
        top = counts.where(F.col("count") >= HOT_COUNT).orderBy(F.desc("count"), "h").limit(HOT_SHINGLES)
        rows = [(r.h, r[1]) for r in top.collect()]
        h, n = np.array([r[0] for r in rows], _S64).view(U64), np.array([r[1] for r in rows], np.int64)
        order = np.argsort(h)
        return h[order], n[order]

    def keys(self, sets: DataFrame, classes: DataFrame) -> DataFrame:
        """(key, n, fp) of the written sets; of a class of many copies, the first member's only."""
        heavy = classes.where(F.col("copies") > HEAVY_COPIES).orderBy(F.desc("copies"), "doc").limit(HEAVY_CLASSES)
        heavy = heavy.select(F.col("n").alias("hn"), F.col("fp").alias("hfp"), F.col("doc").alias("first"))
        sets = sets.where("n > 0").select("doc", "n", "fp", "keys")
        kept = sets.join(F.broadcast(heavy), (sets["n"] == heavy["hn"]) & (sets["fp"] == heavy["hfp"]), "left").where("first IS NULL OR first = doc")
        return kept.select(F.explode("keys").alias("key"), "n", "fp")

    def full_sets(self, pairs: DataFrame) -> DataFrame:
        """(doc, shingles) of the texts in *pairs*.  A Bloom filter of fixed size says which texts can be needed;
        whatever it lets through beyond that falls out of the joins."""
        docs = pairs.select(F.col("a").alias("doc")).union(pairs.select(F.col("b").alias("doc")))
        shared = self.spark.sparkContext.broadcast(bitmap_of(docs, "doc"))
        width = self.width

        def one(doc, w):
            s = shingle_set(w, width)
            return [doc], [set_fingerprint(s)], [s.tobytes()]

        sets = _mapper(one, _FULL, 1 << 12)

        def needed(batches):  # one Python worker a task: filter and sets in one function
            yield from sets(batch.filter(pa.array(may_hold(shared.value, np.asarray(batch.column(0))))) for batch in batches)

        return self.texts.mapInArrow(released(needed), "doc long, fp long, shingles binary").dropDuplicates(["doc", "fp"])

    def near(self, star: DataFrame, classes: DataFrame) -> DataFrame:
        """Pairs of classes ((pn, pfp), (n, fp)) whose sketches are near enough, as documents and fingerprints."""
        side = lambda p: classes.select(F.col("n").alias(f"{p}n"), F.col("fp").alias(f"{p}fp"),
                                        F.col("doc").alias(f"{p}doc"), F.col("sketch").alias(f"{p}sketch"))
        return (star.join(side("p"), ["pn", "pfp"])
                .join(side("").withColumnRenamed("doc", "mdoc"), ["n", "fp"])
                .select(F.col("pdoc").alias("a"), F.col("pfp").alias("afp"), F.col("mdoc").alias("b"), F.col("fp").alias("bfp"),
                        "pn", "n", "psketch", "sketch")
                .mapInArrow(_sketch_filter(self.pct), "a long, afp long, b long, bfp long"))

    def verified(self, near: DataFrame) -> DataFrame:
        """The pairs (a, b) of *near* that are similar."""
        near = settle(near, "near")
        if near.isEmpty():
            return near.select("a", "b")
        full = settle(self.full_sets(near), "sets")
        both = (near.join(full.toDF("a", "afp", "x"), ["a", "afp"]).join(full.toDF("b", "bfp", "y"), ["b", "bfp"]))
        return settle(both.select("a", "b", "x", "y").mapInArrow(released(_exact_filter(self.pct)), "a long, b long"), "links")

    def apart(self, groups: DataFrame, label: DataFrame, classes: DataFrame) -> DataFrame:
        """Near pairs of members of one group that are in different components so far.  A group is cut into tiles of
        about `TILE` members; each pair of tiles is compared by itself.  Groups of two need nothing: their only
        pair was a star's, as were all pairs with a group's first member."""
        rows = groups.select("key", "n", "fp").join(label, ["n", "fp"])
        mixed = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("rows")).where("lo < hi")
        rows = (rows.join(mixed.select("key", F.ceil(F.col("rows") / TILE).cast("int").alias("tiles")), "key")
                .withColumn("block", F.expr("cast(pmod(xxhash64(fp), tiles) as int)"))
                .join(classes.select("n", "fp", "doc", "sketch"), ["n", "fp"])
                .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
                .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "n", "doc", "fp", "label", "sketch"))
        tiles = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        return tiles.mapInArrow(_compare_tiles(self.pct), "a long, afp long, b long, bfp long").distinct()

    def run(self) -> DataFrame:
        pct = self.pct
        sets = settle(self.sets(), "sets")
        classes = sets.where("n > 0").groupBy("n", "fp").agg(F.min("doc").alias("doc"), F.count("*").alias("copies"))
        classes = settle(classes, "classes")
        sketched = settle(classes.join(sets.select("doc", "n", "fp", "sketch").dropDuplicates(["doc", "n", "fp"]),
                                       ["doc", "n", "fp"]), "sketched")
        # an id with several texts is one node: its classes meet in it
        several = sets.where("n > 0").groupBy("doc").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo != hi")
        several = (sets.join(several.select("doc"), "doc").select(F.col("doc").alias("a"), "n", "fp")
                   .join(classes.select("n", "fp", F.col("doc").alias("b")), ["n", "fp"]).select("a", "b"))
        keys = self.keys(sets, classes)
        # the order within a key depends on the key, so the groups of a text have different first members
        groups = keys.repartition("key").sortWithinPartitions("key", F.xxhash64("key", "n", "fp"))
        groups = settle(groups.mapInArrow(_members, "key long, pn int, pfp long, n int, fp long"), "groups")
        fits = F.least("pn", "n") * 100 >= F.greatest("pn", "n") * pct
        one, two = F.struct(F.col("pn").alias("n"), F.col("pfp").alias("fp")), F.struct("n", "fp")
        star = groups.where(fits).select(F.least(one, two).alias("p"), F.greatest(one, two).alias("m")).distinct()
        star = star.select(F.col("p.n").alias("pn"), F.col("p.fp").alias("pfp"), "m.n", "m.fp")
        links = self.verified(self.near(star, sketched))
        parts = components(links.union(several), "a", "b")
        label = classes.join(parts.withColumnRenamed("node", "doc"), "doc", "left").select(
            "n", "fp", F.coalesce("component", "doc").alias("label"))
        more = self.verified(self.apart(groups, label, sketched))
        if not more.isEmpty():
            parts = components(links.union(several).union(more), "a", "b")
        label = classes.join(parts.withColumnRenamed("node", "doc"), "doc", "left").select(
            "n", "fp", F.coalesce("component", "doc").alias("component"))
        return sets.select("doc", "n", "fp").join(label, ["n", "fp"], "left").select(
            "doc", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = WIDTH,
                    threshold_pct: int = THRESHOLD_PCT) -> DataFrame:
    """One row per row of *docs*: the id, n_shingles and component_id (the least id reachable over pairs of
    sets with ``100 * |A & B| >= threshold_pct * |A | B|``, itself included).  Ids are integers; a row with
    a null id is not compared and has nulls.  Rows of one id with different texts are one node."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("binary").alias("body"))
    out = _Join(texts.where("doc is not null"), width, threshold_pct).run()
    no_id = texts.where("doc is null").select("doc", F.lit(None).cast("long"), F.lit(None).cast("long"))
    return out.union(no_id).select(F.col("doc").alias(id_col), "n_shingles", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of *docs* whose id is the least of its near-duplicate group (all columns; null ids stay)."""
    found = near_duplicates(docs, id_col, text_col, **options)
    return without(docs, id_col, found.where(F.col(id_col) != F.col("component_id")).select(id_col))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """*docs* with one row of each near-duplicate group, that of the least id (null ids come last; of equal ids the first
    row).  Every row is judged by itself, whatever its id; all columns stay."""
    rows, key = keyed_rows(docs)
    found = settle(near_duplicates(rows, key, text_col, **options).select(key, "component_id"), "row-groups")
    order = F.struct(F.col(id_col).isNull(), id_col, key)
    least = found.join(rows.select(key, id_col), key).groupBy("component_id").agg(F.min_by(key, order).alias("least"))
    swapped = settle(least.where("least != component_id"), "swapped")  # groups whose least id is not that of the least key
    gone = found.where(F.col(key) != F.col("component_id")).select(key).join(swapped.select(F.col("least").alias(key)), key, "left_anti")
    return without(rows, key, gone.union(swapped.select("component_id"))).drop(key)
