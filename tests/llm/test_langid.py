"""Kernels against sets; held-out accuracy on the given tables."""
import numpy as np

from tollgate.llm import langid as L
from tollgate.llm.queries import op1_language_id

SF = "/root/testdata/sf0.01"


def plain_grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    s = " " + " ".join(words) + " "
    return {s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)} if words else set()


def test_grams_and_kernel():
    texts = ["Hello, World", "a", "", "123 !", "ÀÉ 中文 x😀y", "  a  b ", "x1y", "A" * 1000, "\x01a"]
    sets = [L.gram_set(t) for t in texts]
    assert [len(s) for s in sets[:4]] == [len(plain_grams(t)) for t in texts[:4]] and L.gram_set(None).size == 0
    for t in ("hello world", "  a  b ", "x1y", "aaa", "été à la mer"):
        assert len(L.gram_set(t)) == len(plain_grams(t)), t
    a, b = "hello world", "yellow word"
    x, y = plain_grams(a), plain_grams(b)
    sa, sb = L.gram_set(a), L.gram_set(b)
    assert len(np.intersect1d(sa, sb)) == len(x & y)
    grams = np.unique(np.r_[sa, sb])
    columns = np.isin(grams, sb)[:, None].astype(np.float32)
    assert np.isclose(L.kernel_rows([sa], grams, columns, np.array([len(sb)]))[0, 0], len(x & y) / np.sqrt(len(x) * len(y)))


def test_letters_beyond_the_basic_plane():
    assert L.gram_set("\U0001F600\U0001F601 \U0001F4A9\U0001F44D\U0001F3FD \U0001D7D8").size == 0
    for t in ("x\U0001F600y", "\U00010400\U00010401 \U00020000", "\U0001F600 the dog \U0001F600"):
        assert len(L.gram_set(t)) == len(plain_grams(t)), t
    assert L.gram_set("the \U0001F600 dog \U0001F600").tolist() == L.gram_set("the dog").tolist()
    model = L.fit_sets({"en": [L.gram_set("the cat and the dog walk")], "de": [L.gram_set("der Hund und die Katze gehen")]})
    assert L.predict(model, ["\U0001F600\U0001F601 \U0001F4A9", "the dog \U0001F600"])[0] == ["und", "en"]
    assert L.predict(model, ["\U0001F600"])[1] == [0.0]


def test_held_out(spark):
    rows = op1_language_id(spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_three_hundred_languages(spark):
    rng = np.random.default_rng(6)
    letters = np.array([chr(0x4E00 + i) for i in range(900)])  # three letters of its own and the common ones for each language
    say = lambda k: " ".join("".join(rng.choice([*letters[3 * k : 3 * k + 3], "a", "e"], 5)) for _ in range(12))
    rows = [(300 * j + k, say(k), f"x{k:03}") for k in range(300) for j in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(df.where("doc_id >= 300"))
    assert len(model.languages) == 300
    got = {r.doc_id: r.lang_pred for r in L.identify(df.where("doc_id < 300"), model).collect()}
    assert sum(got[k] == f"x{k:03}" for k in range(300)) >= 295


def test_odd_rows(spark):
    rows = [(i, "the cat and the dog walk" if i % 2 else "der Hund und die Katze gehen", "en" if i % 2 else "de", 0.5) for i in range(60)]
    rows += [(100, None, "en", 0.5), (101, "", "de", 0.5), (102, "12 34!", "de", 0.5), (None, "the dog", "en", 0.5), (103, "und der Hund " * 20_000, None, 0.5), (1, rows[1][1], "en", 0.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = L.fit(df)
    got = [(r.doc_id, r.lang_pred) for r in L.identify(df, model).collect()]
    assert len(got) == len(rows) and set(got) >= {(100, "und"), (101, "und"), (102, "und"), (None, "en"), (103, "de"), (1, "en"), (2, "de")}
    empty = L.fit(df.where("false"))
    assert {r.lang_pred for r in L.identify(df, empty).collect()} == {"und"} and L.identify(df.where("false"), model).collect() == []
