"""Parity-sketch join against all pairs of exact shingle sets."""
import random
import re

import numpy as np
import pytest

from tollgate.llm import ngram_join as J
from tollgate.llm.queries import op4_ngram_jaccard_join
from tollgate.llm.wordhash import U64

SF = "/root/testdata/sf0.001"


def sets_of(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, pct=80):
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = []
    for i, text in rows:
        parent.setdefault(i, i)
        sets.append((i, sets_of(text)))
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= pct * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(df, **more).collect())


def words(rng, n, pool):
    return " ".join(rng.choice(pool) for _ in range(n))


def near_rows(seed):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(300)]
    passage, rows, i = words(rng, 60, pool), [], 0
    for size in (1, 2, 4, 5, 6, 7, 9, 12, 15, 20, 33, 64, 70, 150):
        for _ in range(3):
            base = words(rng, size, pool).split()
            for edits in (0, 0, 1, 2, size // 20, size // 10):
                w = list(base)
                for _ in range(edits):
                    spot = rng.randrange(len(w))
                    w[spot : spot + 1] = rng.choice([[], [rng.choice(pool)], [w[spot], rng.choice(pool)]])
                rows.append((i * 7 % 1009, " ".join(w).upper() if i % 2 else "\t".join(w)))
                i += 1
    for _ in range(40):  # a passage that many texts share
        rows.append((i * 7 % 1009, words(rng, rng.randrange(20, 80), pool) + " " + passage))
        i += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_pairs(spark, seed):
    rows = near_rows(seed)
    rng = random.Random(seed)
    w = words(rng, 400, [f"v{i}" for i in range(900)]).split()
    for k in range(60):  # a chain: neighbours are similar, ends are not
        rows.append((2000 + k, " ".join(w[k * 4 : k * 4 + 150])))
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(5, None), (6, ""), (7, " \t\n"), (8, "a"), (9, "A"), (10, "a b"), (11, "b a"), (12, "x" * 100_000),
            (13, "é É"), (14, "É é"), (15, "a\x0bb"), (16, "a\xa0b"), (3, "q w e r t y u i o p"), (3, "q w e r t y u i o p"),
            (20, "q w e r t y u i o p"), (40, "k l m n o p"), (40, "e f g h i j"), (2, "e f g h i j"), (41, "K l m n o p")]
    assert run(spark, rows) == brute(rows)
    df = spark.createDataFrame([(None, "a b c"), (1, "a b c")], "doc_id long, text string")
    assert sorted(map(tuple, J.near_duplicates(df).collect()), key=str) == [(1, 1, 1), (None, None, None)]
    assert run(spark, []) == []


def test_long_texts(spark):
    rng = random.Random(5)
    w = words(rng, 20_000, [f"w{i}" for i in range(5000)]).split()
    other = list(w)
    for k in range(0, 20_000, 60):
        other[k] = "zz"
    rows = [(1, " ".join(w)), (2, " ".join(other)), (3, " ".join(w[:15_000]))]
    assert run(spark, rows) == brute(rows)


def test_blocks_of_similar_sets_meet():
    rng = np.random.default_rng(0)
    for n in [*range(1, 40), 63, 64, 65, 79, 80, 81, 127, 128, 500]:
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.int64).view(U64))
            most = (n * 100 - n * 80) // 100
            lose = rng.integers(0, most + 1)
            b = np.sort(a[lose:])
            add = 0
            while 100 * len(b) >= 80 * (n + add + 1):
                add += 1
            extra = rng.integers(0, 2**63, rng.integers(0, add + 1), dtype=np.int64).view(U64)
            b = np.unique(np.r_[b, extra])
            hot = np.sort(rng.choice(a, min(len(a), 5), replace=False))
            hot = hot, rng.integers(2, 9, len(hot))
            assert len(np.intersect1d(J.block_keys(a, hot, 80), J.block_keys(b, hot, 80)))
            apart = np.bitwise_count(np.frombuffer(J.narrow_sketch(a), U64) ^ np.frombuffer(J.narrow_sketch(b), U64)).sum()
            assert apart <= len(np.setxor1d(a, b))


def test_keep_one(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 1), (2, "a b c d e f", 2), (3, "other words", 3), (None, "a b c d e f", 4)],
                               "doc_id long, text string, key int")
    assert sorted(r.key for r in J.keep_one(df).collect()) == [1, 3, 4]


def test_query_on_the_tables(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = op4_ngram_jaccard_join(spark, SF)
    assert sorted(map(tuple, got.collect())) == brute(rows)
