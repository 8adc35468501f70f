"""Benchmark decontamination by spaced seeds.

A spaced seed is a fixed mask over consecutive words; the words under its ones
are hashed, those under its zeros may be anything, so a hit survives
substitutions that would break every n-gram.  Seeds of all benchmark items are
joined with seeds of all texts; hits of one text and item on one diagonal (the
same distance between their positions) are verified once, word by word: the
maximal-scoring aligned stretch (+1 for equal words, `MISMATCH` for others) must
hold `MIN_MATCHES` equal words, or `SHORT_SHARE` of an item that is shorter.

The whole of every text is searched.  A Bloom filter of fixed size over the
benchmark's seeds keeps almost all positions of clean texts out of the join,
which is an ordinary shuffled join of seed rows.  Only the neighbourhood of hits
travels on, so memory and shuffle follow the hits, not the corpus.  Equal items
are searched once.

Words are runs of letters, digits and underscores, lower-cased.  An item of fewer
words than the shortest mask has one seed, all its words in a row, and matches only
whole; texts have such seeds of the lengths that occur among items.  Texts and items
without words match nothing, nor do rows with a null id.  Repeated ids are
searched row by row and reported once.  Extra columns are ignored.  Empty tables
give no rows.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.bitmap import bitmap_of, may_hold, without
from tollgate.llm.rows import released
from tollgate.llm.storage import keyed_rows, settle
from tollgate.llm.wordhash import POSITION, U64, hashes, mix

#: Fixed masks of six words each.
MASKS = ("11101011", "110110011", "1100101011")
MISMATCH = -3
MIN_MATCHES = 10
SHORT_SHARE = 0.8
_WORD = re.compile(r"\w+")
_REGION = 128  # hits farther apart belong to different neighbourhoods; also the words kept on either side of one


def _hashes_of(text: str | None) -> np.ndarray:
    return hashes(_WORD.findall(text.lower()) if text else [])


def short_mask(length: int) -> str:
    return "1" * length


def seeds(words: np.ndarray, masks=MASKS) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of every mask at every position."""
    at, hashes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for k, mask in enumerate(masks):
        n = len(words) - len(mask) + 1
        if n <= 0:
            continue
        if "0" not in mask:  # of a short item: the same whatever other masks there are
            k = 100 + len(mask)
        h = np.zeros(n, U64)
        with np.errstate(over="ignore"):
            for i, c in enumerate(mask):
                if c == "1":
                    h += words[i : i + n] * POSITION[i]
        at.append(np.arange(n))
        hashes.append(mix(h, 500 + k).view(np.int64))
    return np.concatenate(at), np.concatenate(hashes)


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """(begin, end, equal words) of the maximal-scoring stretch."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, MISMATCH))])
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    begin = int(np.flatnonzero(total[: end + 1] == low[end])[-1])
    return begin, end, int(equal[begin:end].sum())


def _items():
    def run(batches):
        for batch in batches:
            rows = [(i, words) for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                    if len(words := _hashes_of(t.as_py()))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].tobytes() for r in rows], pa.binary())],
                                             names=["item", "words"])

    return run


def _item_seeds(masks):
    def run(batches):
        for batch in batches:
            for item, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = np.frombuffer(words.as_buffer(), U64)
                at, h = seeds(words, masks if len(words) >= min(map(len, masks)) else (short_mask(len(words)),))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), item, np.int64)), pa.array(at), pa.array(h)], names=["item", "at", "h"])

    return run


def _regions(masks, shared):
    """Neighbourhoods of possible hits: (doc, begin, words, hits)."""
    hit_type = pa.list_(pa.struct([("pos", pa.int64()), ("h", pa.int64())]))

    def run(batches):
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = _hashes_of(text.as_py())
                pos, h = seeds(words, masks)
                keep = may_hold(shared.value, h)
                if not keep.any():
                    continue
                pos, h = pos[keep], h[keep]
                order = np.argsort(pos, kind="stable")
                pos, h = pos[order], h[order]
                cut = np.flatnonzero(np.diff(pos) > _REGION) + 1
                for p, x in zip(np.split(pos, cut), np.split(h, cut), strict=True):
                    begin = max(0, int(p[0]) - _REGION)
                    rows.append((doc, begin, words[begin : int(p[-1]) + 2 * _REGION].tobytes(),
                                 [{"pos": a, "h": b} for a, b in zip(p.tolist(), x.tolist(), strict=True)]))
            if rows:
                doc, begin, around, hits = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(begin, pa.int64()), pa.array(around, pa.binary()),
                                                  pa.array(hits, hit_type)], names=["doc", "begin", "words", "hits"])

    return run


def _verify(masks):
    least = min(map(len, masks))

    def run(batches):
        for batch in batches:
            rows = []
            for doc, item, begin, diagonal, around, item_words in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                a, b = np.frombuffer(around, U64), np.frombuffer(item_words, U64)
                low, high = max(0, begin - diagonal), min(len(b), begin + len(a) - diagonal)
                first, end, matched = best_stretch(a[diagonal + low - begin : diagonal + high - begin] == b[low:high])
                if matched >= (len(b) if len(b) < least else min(MIN_MATCHES, SHORT_SHARE * len(b))):
                    rows.append((doc, item, diagonal + low + first, diagonal + low + end, matched, len(b)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(6)],
                                             names=["doc", "item", "first_word", "end_word", "matched_words", "item_words"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", masks=MASKS) -> DataFrame:
    """One row per pair of a text and a benchmark item that it holds: the ids, first_word and end_word (exclusive) of
    the best stretch in the text, its matched_words, and the item's item_words."""
    spark = docs.sparkSession
    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("t"))
    items = settle(items.mapInArrow(_items(), "item long, words binary"), "items")
    unique = settle(items.groupBy("words").agg(F.min("item").alias("item")).select("item", "words"), "unique-items")
    item_seeds = settle(unique.mapInArrow(_item_seeds(masks), "item long, at long, h long"), "item-seeds")
    shared = spark.sparkContext.broadcast(bitmap_of(item_seeds, "h"))
    size = F.octet_length("words") / 8  # at most one row a length under the shortest mask
    short = [r.n for r in unique.select(size.cast("int").alias("n")).where(F.col("n") < min(map(len, masks))).distinct().orderBy("n").collect()]
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("body"))
    regions = settle(texts.mapInArrow(released(_regions((*masks, *map(short_mask, short)), shared)), "doc long, begin long, words binary, hits array<struct<pos:long,h:long>>")
                     .withColumn("region", F.monotonically_increasing_id()), "regions")
    hits = regions.select("region", F.explode("hits").alias("hit")).select("region", "hit.pos", "hit.h")
    lines = hits.join(item_seeds, "h").groupBy("region", "item", (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.count("*").alias("n"))
    pairs = (lines.join(regions.select("region", "doc", "begin", "words"), "region")
             .join(unique.withColumnRenamed("words", "item_words"), "item")
             .select("doc", "item", "begin", "diagonal", "words", "item_words"))
    found = pairs.mapInArrow(_verify(masks), "doc long, item long, first_word long, end_word long, matched_words long, item_words long")
    found = found.groupBy("doc", "item").agg(F.max_by(F.struct("first_word", "end_word", "matched_words", "item_words"),
                                                      F.struct("matched_words", -F.col("first_word"))).alias("best"))
    same = items.join(unique.withColumnRenamed("item", "least"), "words").select("least", "item").distinct()
    return found.withColumnRenamed("item", "least").join(same, "least").select(
        F.col("doc").alias(id_col), F.col("item").alias(item_col), "best.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of *docs* that hold no benchmark item (all columns)."""
    return without(docs, id_col, contaminated(docs, benchmark, id_col, text_col, **options).select(id_col))


def clean_rows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """As ``decontaminate``, but every row is searched and kept or removed by itself, whatever its id."""
    rows, key = keyed_rows(docs)
    return decontaminate(rows, benchmark, key, text_col, **options).drop(key)
