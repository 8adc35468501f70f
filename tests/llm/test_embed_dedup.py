"""Sign hashing against all cosines."""
import numpy as np

from tollgate.llm import embed_dedup as E
from tollgate.llm.queries import op8_embedding_dedup

SF = "/root/testdata/sf0.1"


def brute(rows, threshold=0.93):
    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = (label, np.array(v, float))
    ids = sorted(good)
    links, parent = {i: 0 for i, *_ in rows}, {i: i for i, *_ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for label in {good[i][0] for i in ids}:
        own = [i for i in ids if good[i][0] == label]
        for n in {len(good[i][1]) for i in own}:
            some = [i for i in own if len(good[i][1]) == n]
            x = np.stack([good[i][1] for i in some])
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            for a, b in zip(*np.nonzero(np.triu(x @ x.T >= threshold, 1)), strict=True):
                links[some[a]] += 1
                links[some[b]] += 1
                p, q = find(some[a]), find(some[b])
                parent[max(p, q)] = min(p, q)
    return {i: (links[i], find(i), find(i) == i) for i in links}


def run(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def test_tables(spark, tmp_path):
    """The given vectors, which hold no near copies, and some of them turned by a little."""
    given = spark.read.parquet(f"{SF}/embeddings.parquet")
    rng = np.random.default_rng(3)
    rows = [(r.vec_id, r.embedding, r.label) for r in given.collect()]
    for i, v, label in rows[:400]:
        turned = [float(x) for x in np.float32(np.array(v) + rng.standard_normal(len(v)) * np.linalg.norm(v) * rng.choice([0.02, 0.04]))]
        rows.append((10_000 + i, turned, label))
    spark.createDataFrame(rows, given.schema).write.parquet(f"{tmp_path}/embeddings.parquet")
    got, want = run(op8_embedding_dedup(spark, str(tmp_path))), brute(rows)
    assert got.keys() == want.keys()
    found, true = sum(x[0] for x in got.values()), sum(x[0] for x in want.values())
    assert true >= 600 and 0.99 * true <= found <= true
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)


def turned(v, cosine, rng):
    """A vector at this cosine to *v*."""
    v = v / np.linalg.norm(v)
    other = rng.standard_normal(len(v))
    other -= (other @ v) * v
    return cosine * v + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def test_recall_at_the_threshold(spark):
    """4,000 pairs at cosines of 0.930 to 0.950, and as many just below 0.93, which never link."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(4000):
        v = rng.standard_normal(48)
        rows += [(3 * i, v.tolist(), i % 3), (3 * i + 1, turned(v, 0.93001 + 0.01999 * i / 4000, rng).tolist(), i % 3), (3 * i + 2, turned(v, 0.9299 - 0.03 * (i % 2), rng).tolist(), i % 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = run(E.near_duplicates(df))
    x = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    true = {(a, b) for i in range(4000) for a, b in ((3 * i, 3 * i + 1), (3 * i, 3 * i + 2), (3 * i + 1, 3 * i + 2)) if x[a] @ x[b] >= 0.93}
    assert len(true) == 4000
    recall = sum(got[i][0] for i in got) / (2 * len(true))
    print("recall at cosines of 0.93 to 0.95:", recall)
    assert E.RECALL - 0.003 <= recall <= 1


def test_distance_cut():
    assert E.distance_cut(100, 1.0) == 0 and E.distance_cut(312, 0.93, 0.5) in (37, 38) and 60 <= E.distance_cut(312, 0.93) <= 75
    assert E.distance_cut(4394, 0.93) < 4394 * 0.16


def test_large_buckets(spark):
    """Equal signs in every table for thousands of vectors: more than a tile, in several batches."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal(8)
    rows = [(i, (base + rng.standard_normal(8) * 1e-7).tolist(), 1) for i in range(2500)] + [(5000 + i, rng.standard_normal(8).tolist(), 1) for i in range(50)]
    got = run(E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)))
    assert all(got[i][:2] == (2499, 0) for i in range(2500)) and got == brute(rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal(16)
    rows = [(i, (base + rng.standard_normal(16) * 0.01).tolist(), 1) for i in range(40, 640)]  # more than a tile
    rows += [(1, base.tolist(), 1), (2, base.tolist(), 1), (2, base.tolist(), 1), (3, base.tolist(), 2), (4, (base * 3).tolist(), 2), (5, base.tolist(), None),
             (6, None, 1), (7, [], 1), (8, [0.0] * 16, 1), (9, [float("nan")] * 16, 1), (10, [None] * 16, 1), (11, [float("inf")] + [1.0] * 15, 1),
             (12, [1.0, 2.0], 1), (13, [1.0, 2.1], 1), (14, (-base).tolist(), 1)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<double>, label int, copies string")
    want = brute(rows)
    assert run(E.near_duplicates(df)) == want and want[2][0] == 601
    nameless = spark.createDataFrame([(None, base.tolist(), 1), (1, base.tolist(), 1)], "vec_id long, embedding array<double>, label int")
    assert run(E.near_duplicates(nameless)) == {None: (None, None, None), 1: (0, 1, True)}
    assert run(E.near_duplicates(df.where("false"))) == {}


def test_forest():
    linked = np.zeros((6, 6), bool)
    for a, b in ((0, 2), (1, 3), (2, 3), (4, 5)):
        linked[a, b] = linked[b, a] = True
    assert E._forest(linked).tolist() == [0, 0, 0, 0, 4, 4]
