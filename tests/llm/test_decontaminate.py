"""Spaced seeds against all alignments, word by word."""
import random
import re

import numpy as np

from tollgate.llm import decontaminate as D
from tollgate.llm.queries import op2_decontaminate

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def brute(docs, items):
    out = set()
    for item, t in items:
        b = words(t)
        if item is None or len(b) < 8:
            continue
        for doc, text in docs:
            a = words(text)
            if doc is None:
                continue
            for diagonal in range(-len(b) + 1, len(a)):
                low, high = max(0, -diagonal), min(len(b), len(a) - diagonal)
                if high - low < 8:
                    continue
                equal = np.array(a[diagonal + low : diagonal + high]) == np.array(b[low:high])
                if D.best_stretch(equal)[2] >= min(10, 0.8 * len(b)):
                    out.add((doc, item))
    return out


def run(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS item", "1 AS words")
    found = D.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len({(r.doc_id, r.item_id) for r in found}) == len(found)
    return {(r.doc_id, r.item_id) for r in found}


def test_substitutions(spark):
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(400)]
    say = lambda n: [rng.choice(pool) for _ in range(n)]
    items = [(i, " ".join(say(rng.choice([8, 9, 14, 30, 59])))) for i in range(12)] + [(50, None), (51, ""), (52, "too short to tell"), (None, " ".join(say(20)))]
    items.append((60, items[3][1].upper() + "!"))  # an equal item
    docs = []
    for i in range(40):
        item = words(items[i % 12][1])
        for _ in range(i // 12 * len(item) // 14):
            item[rng.randrange(len(item))] = "changed"
        if i % 5 == 0:
            item = item[len(item) // 2 :]
        docs.append((i, " ".join(say(rng.choice([0, 3, 700])) + item + say(rng.choice([0, 5, 900])))))
    docs += [(100, None), (101, ""), (102, " ".join(say(3000))), (None, items[0][1]), (5, docs[5][1]), (103, items[1][1] + " x " * 30_000 + items[2][1])]
    want = brute([d for d in docs if d[0] != 103], items) | {(103, 1), (103, 2)}
    got = run(spark, docs, items)
    assert {p for p in want if p in got} == got  # nothing that no alignment shows
    # a stretch of 10 equal words without a seed hit would need a change in every mask at every place
    long = {i for i, t in items if len(words(t)) >= 14}
    assert sum(p in got for p in want if p[1] in long) >= 0.95 * sum(p[1] in long for p in want)
    exact = {(d, i) for d, t in docs for i, x in items if d is not None and i is not None and len(words(x)) >= 8 and " ".join(words(x)) in " ".join(words(t))}
    assert exact <= got


def test_short_items_match_whole(spark):
    items = [(1, "who wrote it"), (2, "Why?"), (3, "one two three four five"), (4, "one two three four five six seven"), (5, "a b c d e f g h"), (6, "!")]
    docs = [(1, "so who wrote it then"), (2, "who wrote that"), (3, "why not, he said"), (4, "zero one two three four five six seven eight"),
            (5, "one two three changed five"), (6, "x " * 5000 + "who wrote it"), (7, "a b c d e f g h"), (8, ""), (9, "it wrote who")]
    assert run(spark, docs, items) == {(1, 1), (3, 2), (4, 3), (4, 4), (6, 1), (7, 5)}


def test_empty(spark):
    assert run(spark, [], [(1, "a b c d e f g h i j")]) == set()
    assert run(spark, [(1, "a b c d e f g h i j")], []) == set()


def test_kept_rows(spark):
    df = spark.createDataFrame([(1, "x a b c d e f g h i j", 0), (2, "a b c", 1), (None, "a b c d e f g h i j", 2)], "doc_id long, text string, words int")
    kept = D.decontaminate(df, spark.createDataFrame([(1, "A b, c d e f g h i J.")], "item_id long, text string"))
    assert sorted(r.words for r in kept.collect()) == [1, 2] and kept.columns == df.columns


def test_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in op2_decontaminate(spark, SF).collect()}
    assert got == {(d, i) for d, t in docs for i, x in items if " ".join(words(x)) in " ".join(words(t))} and got
