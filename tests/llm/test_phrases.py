"""Phrase collocations against counting every phrase in a Counter."""
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgate.llm import phrases as P
from tollgate.llm.queries import ORACLE, op13_phrases

SCHEMA = "lang string, text string, phrase string, n long"


def brute(rows, least, top):
    f = {}
    for lang, text in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            table = f.setdefault(lang if lang is not None else "und", Counter())
            table.update(tuple(words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    out = []
    for lang, table in f.items():
        n = sum(v for p, v in table.items() if len(p) == 1)
        candidates = {p: a for p, a in table.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            inside = any(a <= b and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items())
            if not inside:
                score, k = min((1000 * a * n // (table[p[:k]] * table[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), table[p[:k]], table[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return out


def mined(df, **options):
    return sorted(tuple(r) for r in P.mine(df, **options).collect())


def odd_rows(seed):
    rng = random.Random(seed)
    vocabulary = [*"abcdefgh", "É", "é", "the", "of", "x" * 70, "a-b", "\x1c", "\xa0", "'"]
    rows = [(rng.choice(["en", "en", "fr", None]), "".join(rng.choice(vocabulary) + rng.choice([" "] * 12 + ["  ", "\t", ".", ", ", "\n", "\x0b", "?!"])
                                                           for _ in range(rng.randrange(60)))) for _ in range(300)]
    return rows + [("en", None), ("en", ""), ("xx", " ., "), (None, "Of The " * 500), ("en", "of the " * 4000), ("en", "a b c d e f " * 300)] + rows[:50]


@pytest.mark.parametrize("seed", range(2))
def test_equals_counting(spark, seed, monkeypatch):
    rows = odd_rows(seed)
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], SCHEMA).repartition(3)
    if seed:  # small slices, buffers and parts; hot pairs dealt on
        for name, value in (("_SLICE", 50), ("_HELD", 300), ("_WORDS", 40), ("SHARE", 64), ("SUFFIXES_A_TASK", 500)):
            monkeypatch.setattr(P, name, value)
    for least, top in ((5, 10_000), (20, 7)):
        expected = sorted(brute(rows, least, top))
        assert expected and mined(df, least=least, top=top) == expected


def test_colliding_hashes_start_anew(spark, monkeypatch):
    rows = odd_rows(3)
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], SCHEMA)
    right = P._collide
    tried = []
    monkeypatch.setattr(P, "_collide", lambda words, frequent: tried.append(1) or len(tried) == 1 or right(words, frequent))
    assert mined(df, least=20, top=10_000) == sorted(brute(rows, 20, 10_000)) and len(tried) == 2
    words = spark.createDataFrame([("a", 5), ("b", 5), ("c", 6), ("d", 7), ("e", 7)], "word string, h long")
    assert right(words, words.where("word = 'a'")) and not right(words, words.where("word = 'c'"))


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mined(df) == [] and mined(spark.createDataFrame([("en", "a b", "", 0)], SCHEMA)) == []


@pytest.mark.parametrize("seed", range(6))
def test_quicksort_counts(seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(1, [3, 40][seed % 2], (3000, 5)).astype(np.uint64)
    rows[np.arange(5) >= rng.integers(2, 6, 3000)[:, None]] = 0
    n = rng.integers(1, 4, 3000)
    expected = Counter()
    for row, weight in zip(rows.tolist(), n.tolist(), strict=True):
        for k in range(2, 6):
            if row[k - 1]:
                expected[tuple(row[:k] + [0] * (5 - k))] += weight
    for least, small in ((1, 50), (25, 1), (25, 400)):
        phrase, f = P.sorted_phrases(rows, n, least, small)
        got = dict(zip(map(tuple, phrase.tolist()), f.tolist(), strict=True))
        assert len(got) == len(f) and got == {p: v for p, v in expected.items() if v >= least}


def test_scores_beyond_64_bits(spark):
    a, n, left, right = 3 * 10**15 + 7, 9 * 10**17 + 1, 4 * 10**15 + 1, 5 * 10**15 + 3
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert row.select(P.cut_score(*map(F.col, "anlr")).alias("s")).first().s == 1000 * a * n // (left * right)


def test_the_documents(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in op13_phrases(spark, path).collect()) == sorted(brute(rows, 100, 2000)) and "op13_phrases" in ORACLE
