"""Phrase collocations by a multikey quicksort of suffix pointers.

Texts are lower-cased (A-Z), split into pieces and words, and every word of a
language becomes a 64-bit hash.  A *suffix* is a position of a piece with the words
that follow it, up to `LONGEST`.

1. **Leading words.**  Words, then pairs of frequent words, are counted over all
   texts: the sizes of the parts that suffixes would be dealt to.  Suffixes of an
   infrequent pair are abandoned, and a suffix ends before its first infrequent word or
   pair, since no frequent phrase goes further.
2. **Routing.**  Suffixes of three words or more go to tasks by their leading pair; equal
   ones of a task are added up first.  A pair with more than a fair share of all suffixes is
   dealt on by the whole suffix, and its counts are partial until they are added up.
3. **Sorting.**  Each task sorts pointers to its suffixes with a three-way quicksort, a
   word at a time: the middle part, equal in one more word, is a phrase whose count is
   the part's weight, and is sorted by the next word.  Parts lighter than the least
   count are abandoned (partial ones are not); small parts are finished by a plain sort.

Both filters, of frequent words and of frequent pairs, are bitmaps of fixed size: what
they let through in error is counted like the rest, so they change cost, never
results.  Counts are exact as long as no frequent word shares its hash with another
word of the table, which is tested; if one does, all starts anew with other hashes.

Each cut of a phrase is scored as floor(1000 * a * n / (l * r)) with decimals of 38
digits.  A phrase inside a longer one that is as frequent is dropped; it is enough to
look at phrases of one word more, which are at least as frequent as any longer one.

A null language is ``und``.  Null and empty texts have no words; repeated rows count
as often as they occur; ids are not read.  Memory is bounded by a slice of text, 8
bytes a word of the longest text and a task's share of the suffixes.  Extra columns
are ignored; an empty table gives no rows.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.bitmap import bitmap_of, may_hold
from tollgate.llm.storage import settle
from tollgate.llm.wordhash import POSITION, U64, hashes, mix

LEAST = 100
LONGEST = 5
TOP = 2000
PAIR_BITS = 1 << 26
SHARE = 4  # a leading pair is dealt on if it has over 1 / SHARE of a task's suffixes
SUFFIXES_A_TASK = 1 << 21
SMALL = 2048
_SLICE = 1 << 20
_HELD = 1 << 20  # suffixes or pairs added up at a time
_WORDS = 1 << 18  # words counted before they are handed on
_BREAK = b"."
_PLAIN = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\t", _BREAK * 10 + b" ")


def _seed(lang: str, seed: int) -> int:
    return int.from_bytes(blake2b(f"{seed} {lang}".encode(), digest_size=8).digest(), "little") or 1


def _hashes(words: list[bytes], seed: int) -> np.ndarray:
    """Hashes of words of one language; 0 for a break only."""
    out = np.maximum(hashes(words, seed), U64(1))
    out[out == hashes([_BREAK], seed)] = 0
    return out


def _word_lists(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text and breaks between its pieces, in lists of about a slice."""
    data = data.lower().translate(_PLAIN)
    at = 0
    while at < len(data):
        end = at + _SLICE
        if end < len(data):
            end = max(data.rfind(b" ", at, end), data.rfind(_BREAK, at, end)) + 1
            if end <= at:  # a word longer than a slice
                ends = [x for x in (data.find(b" ", at + _SLICE), data.find(_BREAK, at + _SLICE)) if x >= 0]
                end = min(ends) + 1 if ends else len(data)
        yield data[at:end].replace(_BREAK, b" . ").split()
        at = end


def _texts(batches) -> Iterator[tuple[str, bytes]]:
    """(language, text) with short texts of a language joined by breaks."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        code = np.asarray(langs.indices)
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            held, size = [], 0
            for text in batch.column(1).take(pa.array(np.flatnonzero(code == k))):
                if text.is_valid:
                    held.append(text.as_buffer().to_pybytes())
                    size += len(held[-1])
                    if size >= _SLICE:
                        yield lang, _BREAK.join(held)
                        held, size = [], 0
            if held:
                yield lang, _BREAK.join(held)


def _hashed(batches, seed: int) -> Iterator[np.ndarray]:
    """Word hashes of some texts, 0 between pieces and at the end."""
    for lang, data in _texts(batches):
        own = _seed(lang, seed)
        yield np.concatenate([*(_hashes(words, own) for words in _word_lists(data)), np.zeros(1, U64)])


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(first * POSITION[0] + second * POSITION[1], 2)


def _count_words(seed: int):
    def run(batches):
        held: dict[str, Counter] = {}

        def out():
            for lang, words in held.items():
                words.pop(_BREAK, None)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64()),
                                                  pa.array(_hashes(list(words), _seed(lang, seed)).view(np.int64))],
                                                 names=["lang", "word", "f", "h"])
            held.clear()

        for lang, data in _texts(batches):
            words = held.setdefault(lang, Counter())
            for part in _word_lists(data):
                words.update(part)
            if sum(map(len, held.values())) >= _WORDS:
                yield from out()
        yield from out()

    return run


def _count_pairs(seed: int, frequent):
    """(w0, w1, n) of neighbouring frequent words."""

    def run(batches):
        held, size = [], 0

        def out():
            rows, n, _ = added_up(np.concatenate(held), np.ones(size, np.int64))
            return pa.RecordBatch.from_arrays([*_longs(rows), pa.array(n)], names=["w0", "w1", "n"])

        for h in _hashed(batches, seed):
            ok = may_hold(frequent.value, h) & (h != 0)
            at = np.flatnonzero(ok[:-1] & ok[1:])
            held.append(np.stack([h[at], h[at + 1]], axis=1))
            size += len(at)
            if size >= _HELD:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    return run


def _longs(rows: np.ndarray) -> list[pa.Array]:
    return [pa.array(np.ascontiguousarray(rows[:, k]).view(np.int64)) for k in range(rows.shape[1])]


def _keyed_pairs(batches):
    for batch in batches:
        key = pair_keys(*(np.asarray(batch.column(k)).view(U64) for k in (0, 1)))
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(2)], names=["key", "n"])


def suffixes(h: np.ndarray, ok: np.ndarray, pair_ok: np.ndarray) -> np.ndarray:
    """Suffixes of three words or more, padded with 0: *ok* marks frequent words and *pair_ok* (one shorter) pairs."""
    linked = np.zeros(len(h) + LONGEST, bool)
    linked[: len(h) - 1] = ok[:-1] & ok[1:] & pair_ok
    at = np.flatnonzero(linked[:-1] & linked[1:])
    out = np.zeros((len(at), LONGEST), U64)
    for k in range(3):
        out[:, k] = h[at + k]
    on = np.ones(len(at), bool)
    for k in range(3, LONGEST):
        on &= linked[at + k - 1]
        out[on, k] = h[at[on] + k]
    return out


def added_up(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal neighbours in the order of a hash as one: rows, counts, hashes."""
    with np.errstate(over="ignore"):
        key = mix((rows * POSITION[: rows.shape[1]]).sum(axis=1, dtype=U64), 3)
    order = np.argsort(key, kind="stable")
    rows, key = rows[order], key[order]
    head = np.r_[True, (key[1:] != key[:-1]) | (rows[1:] != rows[:-1]).any(axis=1)]
    return rows[head], np.add.reduceat(n[order], np.flatnonzero(head)), key[head]


_ROUTED = pa.schema([("task", pa.int32()), ("partial", pa.bool_()), ("block", pa.binary())])


def _route(seed: int, frequent, pairs, hot, tasks: int):
    """Suffixes by leading pair; those of a hot one are dealt on.  What a buffer has for one task is one row: the suffixes,
    then their counts."""

    def run(batches):
        held, size = [], 0

        def out():
            rows, n, key = added_up(np.concatenate(held), np.ones(size, np.int64))
            lead = pair_keys(rows[:, 0], rows[:, 1])
            keys, deals = hot.value
            at = np.minimum(np.searchsorted(keys, lead), max(len(keys) - 1, 0))
            deal = np.where(keys[at] == lead, deals[at], 1).astype(U64) if len(keys) else np.ones(len(lead), U64)
            with np.errstate(over="ignore"):
                task = (mix(lead + key % deal, 4) % U64(tasks)).astype(np.int32)
            partial = deal > 1
            order = np.lexsort((partial, task))
            task, partial, rows, n = task[order], partial[order], rows[order], n[order]
            cut = np.flatnonzero((task[1:] != task[:-1]) | (partial[1:] != partial[:-1])) + 1
            first = np.r_[0, cut]
            blocks = [r.tobytes() + c.tobytes() for r, c in zip(np.split(rows, cut), np.split(n, cut), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(task[first]), pa.array(partial[first]), pa.array(blocks, pa.binary())], schema=_ROUTED)

        for h in _hashed(batches, seed):
            ok = may_hold(frequent.value, h) & (h != 0)
            at = np.flatnonzero(ok[:-1] & ok[1:])
            pair_ok = np.zeros(len(h) - 1, bool)
            pair_ok[at] = may_hold(pairs.value, pair_keys(h[at], h[at + 1]))
            held.append(suffixes(h, ok, pair_ok))
            size += len(held[-1])
            if size >= _HELD:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    return run


def _runs(rows: np.ndarray, n: np.ndarray, depth: int, least: int):
    """Phrases of *rows* that agree in their first *depth* words, by a plain sort: (row, words, count)."""
    order = np.lexsort(rows.T[::-1])
    rows, total = rows[order], np.r_[0, np.cumsum(n[order])]
    differs = np.zeros(len(rows), bool)
    differs[0] = True
    for k in range(depth, rows.shape[1]):
        differs[1:] |= rows[1:, k] != rows[:-1, k]
        start = np.flatnonzero(differs)
        weight = total[np.r_[start[1:], len(rows)]] - total[start]
        keep = (weight >= least) & (rows[start, k] != 0)
        if k and keep.any():
            yield order[start[keep]], np.full(keep.sum(), k + 1), weight[keep]


def sorted_phrases(rows: np.ndarray, n: np.ndarray, least: int, small: int = SMALL) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of two words or more, padded with 0, and their counts, among suffixes *rows* with weights *n*: those of
    weight *least* or more, by a three-way quicksort of pointers, a word at a time."""
    found: list[tuple] = []
    todo = [(np.arange(len(rows)), 0)]
    while todo:
        part, depth = todo.pop()
        if not len(part) or n[part].sum() < least:
            continue  # abandoned
        if len(part) <= small:
            found += [(part[i], words, weight) for i, words, weight in _runs(rows[part], n[part], depth, least)]
            continue
        word = rows[part, depth]
        pivot = np.partition(word[:: max(1, len(word) // 9)], 4)[4] if len(word) >= 9 else word[0]
        same = part[word == pivot]
        todo += [(part[word < pivot], depth), (part[word > pivot], depth)]
        weight = n[same].sum()
        if pivot and weight >= least:  # 0: the suffixes end here
            if depth:
                found.append((same[:1], np.array([depth + 1]), np.array([weight])))
            if depth + 1 < rows.shape[1]:
                todo.append((same, depth + 1))
    if not found:
        return rows[:0], n[:0]
    spot, words, weight = (np.concatenate(x) for x in zip(*found, strict=True))
    return np.where(np.arange(rows.shape[1]) < words[:, None], rows[spot], U64(0)), weight


def _sort(least: int):
    """Phrases of three words or more and their counts; suffixes of two are not among the rows."""

    def run(batches):
        held = {False: [], True: []}
        for batch in batches:
            for partial, block in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                block = np.frombuffer(block.as_buffer(), U64)
                cut = len(block) // (LONGEST + 1) * LONGEST
                held[partial].append((block[:cut].reshape(-1, LONGEST).copy(), block[cut:].astype(np.int64)))
        for partial, parts in held.items():
            if not parts:
                continue
            rows, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            phrase, f = sorted_phrases(rows, n, 1 if partial else least)
            longer = phrase[:, 2] != 0
            yield pa.RecordBatch.from_arrays([*_longs(phrase[longer]), pa.array(f[longer])], names=[*(f"w{k}" for k in range(LONGEST)), "f"])

    return run


def _collide(words: DataFrame, frequent: DataFrame) -> bool:
    """Whether a frequent word shares its hash with another word, or any word with a break."""
    if not words.where("h = 0").isEmpty():
        return True
    shared = words.sparkSession.sparkContext.broadcast(bitmap_of(frequent, "h"))

    def may(batches):
        for batch in batches:
            yield batch.filter(pa.array(may_hold(shared.value, np.asarray(batch.column(0)))))

    doubtful = words.select("h").mapInArrow(may, "h long")
    return not doubtful.groupBy("h").count().where("count > 1").join(frequent.select("h"), "h", "left_semi").isEmpty()


def counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All words (lang, word, f, h); frequent ones; and phrases (words as an array of hashes, f) of 2 to `LONGEST` words
    that occur *least* times or more in a language."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("body"))
    for seed in count():
        words = texts.mapInArrow(_count_words(seed), "lang string, word binary, f long, h long")
        words = settle(words.groupBy("lang", "word", "h").agg(F.sum("f").alias("f")), "words")
        frequent = settle(words.where(F.col("f") >= least), "frequent-words")
        if not _collide(words, frequent):
            break
    word_bits = spark.sparkContext.broadcast(bitmap_of(frequent, "h"))
    pairs = texts.mapInArrow(_count_pairs(seed, word_bits), "w0 long, w1 long, n long").groupBy("w0", "w1").agg(F.sum("n").alias("n"))
    pairs = settle(pairs.where(F.col("n") >= least), "pairs")
    keyed = pairs.mapInArrow(_keyed_pairs, "key long, n long")
    pair_bits = spark.sparkContext.broadcast(bitmap_of(keyed, "key", PAIR_BITS))
    total = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / SUFFIXES_A_TASK))
    share = max(1, total // (SHARE * tasks))
    many = keyed.where(F.col("n") > share).toArrow()  # at most SHARE rows a task
    order = np.argsort(key := np.asarray(many.column("key").combine_chunks()).view(U64))
    hot = spark.sparkContext.broadcast((key[order], np.ceil(np.asarray(many.column("n").combine_chunks()) / share).astype(np.int64)[order]))
    routed = texts.mapInArrow(_route(seed, word_bits, pair_bits, hot, tasks), "task int, partial boolean, block binary")
    columns = [f"w{k}" for k in range(LONGEST)]
    found = routed.repartitionById(tasks, F.col("task")).mapInArrow(_sort(least), ", ".join(f"{c} long" for c in [*columns, "f"]))
    found = found.groupBy(*columns).agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    found = found.select(F.filter(F.array(*columns), lambda x: x != 0).alias("words"), "f").union(pairs.select(F.array("w0", "w1"), "n"))
    return words, frequent, settle(found, "phrases")


def cut_score(a, n, left, right):
    """floor(1000 * a * n / (left * right)), exactly."""
    wide = lambda c: c.cast("decimal(19,0)")
    top, low = wide(a).cast("decimal(38,0)") * 1000 * wide(n), wide(left) * wide(right)
    return F.call_function("div", top, low.cast("decimal(38,0)"))


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first *top* phrases that occur *least* times or more."""
    words, frequent, phrases = counts(docs, text_col, lang_col, least=least)
    size = F.size("words")
    # inside a phrase of one word more that is as frequent
    longer = phrases.where(size > 2).select(F.explode(F.array(F.slice("words", 1, size - 1), F.slice("words", F.lit(2), size - 1))).alias("words"), "f")
    longer = settle(longer.groupBy("words").agg(F.max("f").alias("most")), "longer")
    kept = phrases.join(longer, "words", "left").where("most IS NULL OR most < f").select("words", F.col("f").alias("a"))
    # words and language
    spelled = (kept.select("words", "a", F.posexplode("words").alias("k", "h")).join(frequent.select("h", "lang", F.col("word").cast("string").alias("word")), "h")
               .groupBy("words", "a").agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("k", "word"))).alias("spelled")))
    spelled = spelled.select("words", "a", "lang", F.array_join(F.transform("spelled", lambda x: x.word), " ").alias("phrase"))
    totals = settle(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    # the lowest-scoring cut
    part = settle(phrases.union(frequent.select(F.array("h"), "f")).toDF("part", "f"), "parts")
    cuts = spelled.join(totals, "lang").withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = (cuts.withColumn("head", F.slice("words", F.lit(1), F.col("k"))).withColumn("tail", F.slice("words", F.col("k") + 1, size - F.col("k")))
            .join(part.select(F.col("part").alias("head"), F.col("f").alias("l")), "head")
            .join(part.select(F.col("part").alias("tail"), F.col("f").alias("r")), "tail"))
    score = F.struct(cut_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(score).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    return (scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
