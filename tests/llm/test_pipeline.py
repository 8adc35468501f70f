"""Each stage against a plain version of it, on its own input."""
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.test_decontaminate import words
from tests.llm.test_ngram_join import brute
from tests.llm.test_tokens import check_pieces
from tollgate.llm import secrets, toxicity
from tollgate.llm.storage import settle, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    docs = table(spark, SF, "documents")
    docs = docs.union(docs.where("doc_id < 3").withColumn("doc_id", F.col("doc_id") + 10_000))  # exact copies
    docs = docs.union(docs.where("doc_id = 5").select((F.col("doc_id") + 20_000).alias("doc_id"), F.concat("text", F.lit(" password = 'correct-horse'")).alias("text"),
                                                      "lang", "source", "n_chars"))
    items = [words(r.text) for r in table(spark, SF, "benchmark").collect()]
    want = {}
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    scorer = toxicity.Scorer(model)
    finder = secrets.Finder("byte_bpe_50k.tiktoken", secrets.MAX_RATIO)
    for name, stage in P.STAGES:
        rows = {r.doc_id: r.text for r in docs.collect()}
        columns = docs.columns
        docs = settle(stage(spark, docs, SF), "test-stage")
        if name == "packing":
            assert check_pieces(docs.collect(), rows, 2048) < 0.02
            break
        assert docs.columns == columns
        if name == "toxicity":
            want = {i for i, t in rows.items() if scorer.score(sum(p[3] for p in scorer.passages(t))) < 0.7}
        elif name == "near_duplicates":
            want = {i for i, _, c in brute(list(rows.items())) if i == c}
        elif name == "decontamination":
            want = {i for i, t in rows.items() if not any(" ".join(x) in " ".join(words(t)) for x in items)}
        else:
            want = {i for i, t in rows.items() if not finder.spans(t)}
        assert {r.doc_id for r in docs.collect()} == want
        assert 0 < len(want) <= len(rows)


def test_odd_documents(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, None, "en", "s", 0), (None, "token: abcdefgh", "en", "s", 1), (4, "x " * 50_000, "de", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.where("false")):
        for name, stage in P.STAGES:
            some = settle(stage(spark, some, SF), "test-stage")
            if name == "secrets":
                assert some.where("text LIKE 'token%'").count() == 0
    assert some.count() == 0


def test_rows_without_an_own_id(spark):
    item, second = (r.text for r in table(spark, SF, "benchmark").orderBy("item_id").limit(2).collect())
    copy, other = "some text that is there several times in this table of documents", "a clean text that shares its id with another row"
    rows = [(9, copy), (None, copy), (4, copy), (4, copy), (None, copy + " "), (7, f"before {item} after"), (7, other), (None, f"and {second} too"), (None, "a clean text of no id")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    stages = dict(P.STAGES)
    kept = settle(stages["near_duplicates"](spark, docs, SF), "test-stage")
    assert kept.columns == docs.columns and [(r.doc_id, r.text) for r in kept.where(F.trim("text") == copy).collect()] == [(4, copy)]
    assert kept.count() == 5
    clean = stages["decontamination"](spark, kept, SF)
    assert clean.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted([(4, copy), (7, other), (None, "a clean text of no id")], key=str)


def test_columns_of_any_name_stay(spark):
    """An input column may have the name that rows' keys would get."""
    text = "some text that is there several times in this table of documents"
    item = table(spark, SF, "benchmark").first().text
    docs = spark.createDataFrame([(1, text, 7, 8), (2, text, 5, 8), (3, item, 9, 8), (4, "a clean one", 3, 8)], "doc_id long, text string, _row_key long, extra int")
    stages = dict(P.STAGES)
    kept = settle(stages["near_duplicates"](spark, docs, SF), "test-stage")
    assert kept.columns == docs.columns and sorted((r.doc_id, r["_row_key"]) for r in kept.collect()) == [(1, 7), (3, 9), (4, 3)]
    clean = stages["decontamination"](spark, kept, SF)
    assert clean.columns == docs.columns and sorted((r.doc_id, r["_row_key"]) for r in clean.collect()) == [(1, 7), (4, 3)]
