"""Token counts and packing against the tokenizers library."""
import random
import zlib

import numpy as np
import pytest

from tollgate.llm import packing as P
from tollgate.llm import token_count as C
from tollgate.llm.queries import op9_packing, op10_token_counts
from tollgate.llm.vocabulary import WordIds, load_tokenizer

SF = "/root/testdata/sf0.001"
ALPHABET = "aAzZ '’.,!?s\t\n\r\x0b\x1c\x85\xa0 ​0123²½ªµºÀßÿĀİıŁŒſǅɏ×÷©<|>éń́中文Σςσ١\"()-_/\\@#😀"
FIXED = [None, "", " ", "<|endoftext|>", "a <|endoftext|><|endoftext|> b", "<|startoftext|>x", "don't WE'LL I'D 's 'S", "a" * 3000,
         "ab" * 1500, "  \n\n  x", " " * 500, "é́ ﬁ 中文 Σς", "x" * 100_000]


def odd_texts():
    rng = random.Random(3)
    return FIXED + ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(1500)]


def test_counts_equal_the_library(spark):
    texts = odd_texts()
    t = load_tokenizer("byte_bpe_50k.json")
    df = spark.createDataFrame([(i, x, "d") for i, x in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in C.count_tokens(df, batch_chars=5000).collect()}
    for i, x in enumerate(texts):
        n = len(t.encode(x or "", add_special_tokens=False).ids)
        assert got[i] == (len((x or "").encode()), n, n > 1024), (x or "")[:60]
    assert C.count_tokens(df.where("false")).collect() == []


def test_counts_of_the_documents(spark):
    t = load_tokenizer("byte_bpe_50k.json")
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op10_token_counts(spark, SF).collect():
        assert r.n_tokens == len(t.encode(rows[r.doc_id] or "", add_special_tokens=False).ids)


def test_word_ids_equal_the_library():
    w, t = WordIds("word_bpe_49k.json", limit=500), load_tokenizer("word_bpe_49k.json")
    for x in odd_texts():
        assert np.frombuffer(w.ids(x), "<u4").tolist() == t.encode(x or "", add_special_tokens=False).ids


def check_pieces(rows, texts, capacity):
    t = load_tokenizer("word_bpe_49k.json")
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(docs) == set(texts)
    for i, pieces in docs.items():
        ids = np.array([*t.encode(texts[i] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / max(total, 1)


def test_packing_of_the_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert check_pieces(op9_packing(spark, SF).collect(), texts, 2048) < 0.01


def test_packing_of_odd_rows(spark):
    texts = dict(enumerate(odd_texts()))
    df = spark.createDataFrame([(i, x, 0) for i, x in texts.items()], "doc_id long, text string, length int").repartition(3)
    from pyspark.sql import functions as F

    for capacity in (128, 2048):
        rows = P.pack(df, capacity=capacity).withColumn("ids_crc32", F.crc32("ids"))
        assert check_pieces(rows.collect(), texts, capacity) < 0.05
    assert P.pack(df.where("false")).collect() == []


def cost(length, capacity):
    if length < capacity and length & (length - 1) == 0:
        return min(capacity - length, P.HARD_PENALTY)
    return capacity - length


def best(position, penalty, capacity):
    f = {0: 0}
    for p, e in zip(position, penalty, strict=True):
        f[p] = e + min(v + cost(p - i, capacity) for i, v in f.items() if p - i <= capacity)
    return f


@pytest.mark.parametrize("seed", range(20))
def test_cuts_are_optimal(seed):
    rng = np.random.default_rng(seed)
    position = np.cumsum(rng.integers(1, 40, 60))
    penalty = rng.choice([0, 2, 16], 60)
    cuts = P.choose_cuts(position, penalty, 100, last=True)
    extra = dict(zip(position.tolist(), penalty.tolist(), strict=True))
    spent = sum(extra[b] + cost(b - a, 100) for a, b in zip([0, *cuts], cuts, strict=False))
    assert spent == best(position.tolist(), penalty.tolist(), 100)[position[-1]] and cuts[-1] == position[-1]


def test_power_steps():
    assert P.power_steps(2048) == [] and P.power_steps(1536) == [1024] and P.power_steps(7) == [4, 6] and P.power_steps(1) == []
