"""Hard negatives against all inner products in Python integers."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgate.llm import hard_negatives as H
from tollgate.llm.queries import ORACLE, op12_hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, score string"


def brute(rows, is_anchor, positives=5, negatives=5):
    """Over (id, vector, label), with exact integers."""
    usable = {}
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.setdefault(i, (label, [math.floor(256 * x) for x in v]))
    out = set()
    for a, (label, v) in usable.items():
        if not is_anchor(a):
            continue
        score = {i: sum(x * y for x, y in zip(v, w, strict=True)) for i, (_, w) in usable.items() if i != a and len(w) == len(v)}
        near = sorted((i for i in score if usable[i][0] == label), key=lambda i: (-score[i], i))[:positives]
        for p in near:
            fits = [i for i in score if usable[i][0] != label and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            for k, i in enumerate(sorted(fits, key=lambda i: (-score[i], i))[:negatives], 1):
                out.add((a, p, k, i, score[p], score[i]))
    return out


def mined(df, is_anchor, **options):
    rows = H.mine(df, is_anchor, **options).collect()
    got = {(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("spread", [0.1, 1.0])
def test_equals_brute_force(spark, spread, monkeypatch):
    rng = np.random.default_rng(int(10 * spread))
    centre = rng.standard_normal((6, 24))
    label = rng.integers(0, 6, 900)
    x = centre[rng.integers(0, 6, 900)] + spread * rng.standard_normal((900, 24))
    x[rng.random(900) < 0.3] = centre[0]  # a vector that a third of all rows hold: ties in score
    rows = [(int(i), v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)
    expected = brute(rows, lambda i: i % 10 == 0)
    assert len(expected) > 500
    monkeypatch.setattr(H, "LEAST_SLICE", 100)
    assert mined(df, F.col("id") % 10 == 0) == expected
    monkeypatch.setattr(H, "BLOCK_BYTES", 40_000)  # several blocks of anchors
    assert mined(df, F.col("id") % 10 == 0) == expected


def test_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(rng.choice([3, 8, 9]))], rng.randrange(3)) for i in range(150)]
    rows += [(200, None, 1), (201, [1.0, None, 2.0], 1), (202, [nan, 1.0, 1.0], 1), (203, [inf, 1.0, 1.0], 2), (204, [0.5, 0.5, 0.5], None),
             (None, [0.5, 0.5, 0.5], 1), (205, [], 1), (206, [], 1), (207, [], 2), (208, [0.0] * 8, 0), (209, [-0.0] * 8, 1), (300, [1e30] * 8, 1)]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows + rows[:40]], SCHEMA)
    expected = brute([r for r in rows if r[0] != 300], lambda i: i % 3 == 0)
    assert expected and mined(df, F.col("id") % 3 == 0) == expected
    assert H.mine(df.where("false"), F.col("id") == 0).collect() == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.integers(-(1 << 18), 1 << 18, 16) + rng.random(16)).tolist(), i % 2) for i in range(200)]
    rows += [(1000 + i, [float(1 << 20) - i] * 16, i % 2) for i in range(20)]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)
    assert mined(df, F.col("id") % 2 == 0) == brute(rows, lambda i: i % 2 == 0)


def test_bounds_hold_and_drop_pairs():
    rng = np.random.default_rng(4)
    x = np.floor(256 * rng.standard_normal((200, 48)))
    s = H.Summaries(*H.finest_sums(x), 48)
    exact = x @ x.T
    assert list(s.steps) == [1, 2, 4, 8]
    before = None
    for mean, deviation in s.steps.values():
        low, high = mean @ mean.T - deviation @ deviation.T, mean @ mean.T + deviation @ deviation.T
        assert (low <= exact + 0.01).all() and (exact <= high + 0.01).all()
        if before is not None:
            assert (high <= before + 0.01).all()  # refined
        before = high
    ids = np.arange(4000)
    x = np.repeat(np.floor(256 * rng.standard_normal((4000, 8))), 6, axis=1)  # even within segments: bounds are tight
    sums = np.concatenate(H.finest_sums(x), axis=1)
    rows = H._Vectors(ids, ids % 2, 48, [v.astype("<i8").tobytes() for v in x], [v.tobytes() for v in sums])
    tile = H.Tile(rows.of(np.arange(50)), np.full((50, 1), H._NONE + 1), np.full((50, 1), np.iinfo(np.int64).max), 5, True)
    for begin in range(0, 4000, 200):
        tile.feed(rows.of(np.arange(begin, begin + 200)))
    assert tile.scored < 0.5 * 50 * 2000


def test_the_embeddings(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got = {(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in op12_hard_negatives(spark, path).collect()}
    assert got == brute(rows, lambda i: i % 100 == 0) and "op12_hard_negatives" in ORACLE
