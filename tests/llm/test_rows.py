"""Filters by Python: every column stays, and whole rows are not sent through the workers."""
import pyarrow as pa
from pyspark.sql import functions as F

from tollgate.llm import secrets, toxicity
from tollgate.llm.bitmap import without
from tollgate.llm.rows import released
from tollgate.llm.storage import settle

ROWS = [(1, "a clean text", "x"), (1, "token: abcdefgh", "y"), (2, None, None), (None, "token: abcdefgh", "z"), (None, "", "w"), (5, "words", "v")]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_the_judged_column_goes_to_python(spark):
    docs = settle(spark.createDataFrame(ROWS, "doc_id long, text string, extra string"), "test-rows")
    gone = spark.createDataFrame([(1,), (None,), (7,)], "doc_id long")
    model = toxicity.Model({"token": 50.0}, 1.0, 1.0, 0.0)
    for kept, column, want in [(without(docs, "doc_id", gone), "doc_id", [r for r in ROWS if r[0] != 1]),
                               (secrets.keep_clean(docs), "text", [r for r in ROWS if not (r[1] or "").startswith("token")]),
                               (toxicity.keep_clean(docs, model), "text", [r for r in ROWS if not (r[1] or "").startswith("token")])]:
        assert kept.schema == docs.schema
        assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)
        assert "MapInArrow" not in plan(kept) and f"ArrowEvalPython [run({column}#" in plan(kept)
        assert kept.where(F.lit(False)).count() == 0


def test_arrow_memory_is_given_back_at_the_end(monkeypatch):
    calls = []

    class Pool:
        def release_unused(self):
            calls.append(1)

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    out = released(lambda batches: (x + 1 for x in batches))(iter([1, 2]))
    assert next(out) == 2 and not calls
    assert list(out) == [3] and calls == [1]
