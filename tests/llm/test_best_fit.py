"""Vector best-fit packing against piece-by-piece best fit and the tokenizers library."""
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgate.llm import best_fit as B
from tollgate.llm.byte_ids import ByteIds
from tollgate.llm.queries import op11_best_fit_packing
from tollgate.llm.vocabulary import load_tokenizer

from .test_tokens import odd_texts

SF = "/root/testdata/sf0.001"


def one_by_one(length, tokens, documents, attention, weights):
    """Best fit piece by piece: the least weighted norm of what is left, the first opened on ties."""
    out, bins = {}, []
    for i in sorted(range(len(length)), key=lambda i: (-length[i], i)):
        need = np.array([length[i], 1, length[i] ** 2])
        fits = [k for k, b in enumerate(bins) if (b >= need).all()]
        if fits:
            norm = [(((np.sqrt(np.array(weights)) / [tokens, documents, attention]) * (bins[k] - need)) ** 2).sum() for k in fits]
            k = fits[int(np.argmin(norm))]
        else:
            k = len(bins)
            bins.append(np.array([tokens, documents, attention]))
        out[i] = (k, tokens - bins[k][0])
        bins[k] = bins[k] - need
    return [out[i] for i in range(len(length))]


@pytest.mark.parametrize("seed", range(12))
def test_equals_one_by_one(seed):
    rng = np.random.default_rng(seed)
    length = rng.integers(1, [20, 64, 100][seed % 3], 300)
    documents, attention = [(100, 10_000), (3, 10_000), (100, 4_500), (4, 5_000)][seed % 4]
    length = np.minimum(length, math.isqrt(attention))
    weights = [(1, 0.01, 0.01), (1, 1, 1)][seed % 2]
    found = B.best_fit(length, 100, documents, attention, weights)
    assert list(zip(*(x.tolist() for x in found), strict=True)) == one_by_one(length, 100, documents, attention, weights)


def check(rows, texts, capacity, most=None, documents=None, attention=None):
    """Every id of every document in one piece, sequences gapless and under every constraint; (sequences, least possible)."""
    t, most = load_tokenizer("byte_bpe_50k.json"), most or capacity
    docs, sequences, total = {}, {}, 0
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(docs) == set(texts)
    for i, pieces in docs.items():
        ids = np.array([*t.encode(texts[i] or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // most)))
        assert all(r.length == most for r in pieces[1:]) and [r.start for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist()
        assert sum(r.length for r in pieces) == len(ids)
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity and len(pieces) <= (documents or at) and sum(r.length**2 for r in pieces) <= (attention or capacity**2)
    return len(sequences), -(-total // capacity)


def test_the_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got, least = check(op11_best_fit_packing(spark, SF).collect(), texts, 2048)
    assert got <= least + 1


def test_odd_rows_under_every_constraint(spark):
    texts = dict(enumerate(odd_texts()))
    df = spark.createDataFrame([(i, x, 0, "k") for i, x in texts.items()], "doc_id long, text string, length int, key string").repartition(3)
    crc = F.crc32("ids").alias("ids_crc32")
    assert np.subtract(*check(B.pack(df).select("*", crc).collect(), texts, 2048)) <= 1
    most = math.isqrt(9_000)
    rows = B.pack(df, capacity=128, documents=5, attention=9_000).select("*", crc).collect()
    check(rows, texts, 128, most, 5, 9_000)
    assert B.pack(df.where("false")).collect() == []


def test_groups_and_null_ids(spark):
    rows = spark.range(1000).select(F.col("id").alias("key"), (F.col("id") % 90 + 1).alias("length"))
    path = "/tmp/tollgate-best-fit"
    rows.write.mode("overwrite").parquet(path)
    got = B.place(spark.read.parquet(path), capacity=100, group=300).collect()
    used = {}
    for r in got:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert len(got) == 1000 and max(used.values()) <= 100 and len({s >> 36 for s in used}) > 1
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (7, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.length) for r in B.pack(df).collect()) == [(0, 3), (0, 3), (7, 1)]


def test_ids_equal_the_library():
    ids, t = ByteIds("byte_bpe_50k.json", limit=300), load_tokenizer("byte_bpe_50k.json")
    for x in [*odd_texts(), " lead", "trail ", "a  b", "a \n b", "a\t \nx", "a <|endoftext|> b", "x" * 200 + " " + "é" * 100]:
        assert np.frombuffer(ids.of(x), "<u4").tolist() == t.encode(x or "", add_special_tokens=False).ids


def test_ids_of_a_vocabulary_that_splits_otherwise():
    ids, t = ByteIds("word_bpe_49k.json"), load_tokenizer("word_bpe_49k.json")
    for x in ("Hello, World don't stop", "a b  c", "ÀÉ x"):
        assert np.frombuffer(ids.of(x), "<u4").tolist() == t.encode(x, add_special_tokens=False).ids
