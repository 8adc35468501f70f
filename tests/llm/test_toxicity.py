"""Segments against all intervals; held-out accuracy on the given tables."""
import numpy as np
from pyspark.sql import functions as F

from tollgate.llm import toxicity as T
from tollgate.llm.queries import op7_toxicity

SF = "/root/testdata/sf0.01"


def all_maximal(scores):
    """Recursive definition: the best interval, then the same left and right of it."""
    def go(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > 1e-12 and (best is None or total > best[2] + 1e-12):
                    best = (i, j + 1, total)
        if best:
            yield from go(a, best[0])
            yield best
            yield from go(best[1], b)

    return list(go(0, len(scores)))


def test_segments():
    rng = np.random.default_rng(0)
    for _ in range(300):
        scores = np.where(rng.random(25) < 0.4, rng.integers(1, 5, 25), -rng.integers(1, 5, 25)).astype(float)
        scores += rng.random(25) / 100  # no ties
        got = T.segments(scores)
        assert [x[:2] for x in got] == [x[:2] for x in all_maximal(scores)]
        assert np.allclose([x[2] for x in got], [x[2] for x in all_maximal(scores)])
    assert T.segments(np.array([-1.0])) == [] and T.segments(np.empty(0)) == []


def test_lambda():
    p, s = np.array([0.9, 0.1]), np.array([-1.0, 2.0])
    assert abs((p * np.exp(T.solve_lambda(p, s) * s)).sum() - 1) < 1e-6


def test_held_out(spark):
    out = op7_toxicity(spark, SF)
    rows = out.collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic IS NOT NULL").collect()}
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    hit, toxic, clean = sum(y and p for y, p in held), sum(y for y, _ in held), sum(not y for y, _ in held)
    assert hit >= 0.6 * toxic and sum(p for y, p in held if not y) <= 0.02 * clean  # some 40 toxic texts to learn from


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    say = lambda some, n: rng.choice(some.split(), n).tolist()
    plain = "the quick brown fox jumps over lazy dogs and runs away from them while some other animals sleep under trees all day"
    docs = [(i, " ".join(say(plain, 14) + (say("awful rotten creature", 4) if i % 2 else []) + say(plain, 9))) for i in range(200)]
    docs += [(500, None), (501, ""), (502, "  !!"), (None, "awful"), (503, "word " * 100_000)]
    df = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(7, 0), (None, 1), (500, 0), (9, None)], "doc_id long, toxic int")
    model = T.fit(df, labels)
    got = {r.doc_id: r for r in T.score(df, model).collect()}
    assert all(got[i].score >= 0.7 for i in range(1, 200, 2)) and all(got[i].score < 0.5 for i in range(0, 200, 2))
    assert got[500].score == got[501].score == got[502].score and got[503].score < 0.5
    p = got[1].passages[0]
    assert set(docs[1][1][p.begin : p.end].split()) & {"awful", "rotten", "creature"}
    for some in (labels.where("toxic = 0"), labels.where("false"), labels.where("toxic = 1")):
        empty = T.fit(df, some)
        assert all(0 <= r.score < 0.7 for r in T.score(df, empty).collect())
    assert T.score(df.where("false"), model).collect() == []
    assert T.fit(df.where("false"), labels).weights == {}


def test_query_never_reads_held_out_labels(spark, tmp_path):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    hidden = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.withColumn("toxic", F.when(hidden, 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int")).write.parquet(f"{tmp_path}/labels.parquet")
    one, two = (sorted((r.doc_id, round(r.score, 9)) for r in op7_toxicity(spark, d).collect()) for d in (SF, str(tmp_path)))
    assert one == two
