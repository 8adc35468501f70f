"""Exact token counts of a byte-level BPE, by rank-synchronous merging of arrays.

Texts are cut into pre-tokens; the distinct new pre-tokens of a batch become
one ragged array of symbols.  In each round every pre-token applies its pair of
lowest rank, at all its places at once (left to right where they overlap, as in
``aaa``), until no pair has a rank; what survives is the count.  Merging all
places of the lowest pair together is what one-by-one merging gives, because a
merge only makes pairs that rank behind it.  Counts of at most `REMEMBERED`
pre-tokens are kept per task, longer ones than `KEEP_CHARS` not at all.

Nothing is shuffled.  Null texts are empty and have 0 tokens; strings of
special tokens in a text are one token each, as in the library's default.
Repeated rows count alike, extra columns are ignored, an empty table gives no
rows.
"""
from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.vocabulary import byte_letters, vocabulary_path

LIMIT = 1024
REMEMBERED = 400_000
KEEP_CHARS = 64
_SPACE = "\\t-\\r \x85\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The vocabulary's own split pattern: a fixed value, for all texts and for texts of Latin letters.
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
PRE_TOKEN_LATIN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zªµºÀ-ÖØ-öø-ɏ]+| ?[0-9²³¹¼-¾]+|"
                   rf" ?[^{_SPACE}0-9A-Za-zª²³µ¹º¼-¾À-ÖØ-öø-ɏ]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
LATIN = "[\t\n\r\x20-\x7e\xa1-ɏ]*"
_NONE = np.int64(1 << 40)


class PairRanks:
    """Ranks and results of the merges of a byte-level vocabulary, as sorted arrays."""

    def __init__(self, name: str):
        with open(vocabulary_path(name), encoding="utf-8") as f:
            data = json.load(f)
        vocab = data["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        left, right, made = (np.array([vocab[x] for x in column], np.int64) for column in
                             ((m[0] for m in merges), (m[1] for m in merges), (m[0] + m[1] for m in merges)))
        key = (left << 20) | right
        self.order = np.argsort(key, kind="stable")
        self.key, self.made = key[self.order], made  # made: by rank
        self.byte = np.array([vocab[c] for _, c in sorted(byte_letters().items())], np.int64)
        self.special = [t["content"] for t in data["added_tokens"]]

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 20) | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.order[at], _NONE)


def merged_lengths(pieces: list[bytes], ranks: PairRanks) -> np.ndarray:
    """How many symbols of each (non-empty) piece survive."""
    out = np.array([len(p) for p in pieces], np.int64)
    symbol = ranks.byte[np.frombuffer(b"".join(pieces), np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), out)
    pair = np.append(np.where(owner[1:] == owner[:-1], ranks.of(symbol[:-1], symbol[1:]), _NONE), _NONE)
    while True:
        start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        size = np.diff(np.append(start, len(owner)))
        least = np.minimum.reduceat(pair, start)
        out[owner[start]] = size
        alive = least != _NONE
        if not alive.any():
            return out
        if not alive.all():  # finished pieces leave
            keep = np.repeat(alive, size)
            symbol, owner, pair = symbol[keep], owner[keep], pair[keep]
            size, least = size[alive], least[alive]
        here = pair == np.repeat(least, size)
        again = here.copy()
        again[1:] &= here[:-1]
        if again.any():  # runs of overlapping places: every second one merges
            index = np.arange(len(here))
            first = np.maximum.accumulate(np.where(here & ~again, index, 0))
            here &= (index - first) % 2 == 0
        spot = np.flatnonzero(here)
        symbol[spot] = ranks.made[pair[spot]]
        keep = np.ones(len(symbol), bool)
        keep[spot + 1] = False
        moved = (np.cumsum(keep) - 1)[spot]
        pair[spot] = pair[spot + 1]
        symbol, owner, pair = symbol[keep], owner[keep], pair[keep]
        for place in (moved, moved[moved > 0] - 1):
            place = place[place + 1 < len(owner)]
            place = place[owner[place] == owner[place + 1]]
            pair[place] = ranks.of(symbol[place], symbol[place + 1])


class TokenCounter:
    """Counts tokens of whole texts; remembers the counts of short pre-tokens."""

    def __init__(self, name: str):
        import regex

        self.ranks = PairRanks(name)
        self.any_text, self.latin, self.is_latin = regex.compile(PRE_TOKEN), re.compile(PRE_TOKEN_LATIN), re.compile(LATIN)
        self.special = re.compile("|".join(map(re.escape, sorted(self.ranks.special, key=len, reverse=True))))
        self.known: dict[str, int] = {}

    def split(self, text: str) -> list[str]:
        return (self.latin if self.is_latin.fullmatch(text) else self.any_text).findall(text)

    def batch(self, texts: list[str | None]) -> list[int]:
        cut, fixed = [], []
        for text in texts:
            parts = self.special.split(text or "") if self.ranks.special else [text or ""]
            fixed.append(len(parts) - 1)
            cut.append(self.split(parts[0]) if len(parts) == 1 else [x for p in parts for x in self.split(p)])
        new = list({x for c in cut for x in c if x not in self.known})
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list({x for c in cut for x in c})
        if new:
            self.known.update(zip(new, merged_lengths([x.encode() for x in new], self.ranks).tolist(), strict=True))
        out = [f + sum(map(self.known.__getitem__, c)) for f, c in zip(fixed, cut, strict=True)]
        for x in new:
            if len(x) > KEEP_CHARS:
                del self.known[x]
        return out


def _count(vocabulary: str, batch_chars: int):
    def run(batches):
        counter = TokenCounter(vocabulary)
        for batch in batches:
            doc, text = batch.column(0), batch.column(1)
            counts, part, size = [], [], 0
            for t in text:
                part.append(t.as_py())
                size += len(part[-1] or "")
                if size >= batch_chars:
                    counts += counter.batch(part)
                    part, size = [], 0
            counts += counter.batch(part)
            yield pa.RecordBatch.from_arrays([doc, pa.array(counts, pa.int64()), batch.column(2)], names=["doc", "n_tokens", "n_bytes"])

    return run


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str = "byte_bpe_50k.json",
                 limit: int = LIMIT, batch_chars: int = 1 << 21) -> DataFrame:
    """One row per row of *docs*: the id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > *limit*)."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), text.alias("body"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    out = rows.mapInArrow(_count(vocabulary, batch_chars), "doc long, n_tokens long, n_bytes long")
    return out.select(F.col("doc").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
