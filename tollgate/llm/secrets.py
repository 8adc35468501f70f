"""Secrets in texts: fixed patterns, plus strings that a tokenizer finds hard to compress.

Fixed patterns give spans of kinds ``assign``, ``access`` and ``hex``.  The
method adds kind ``random``: a string with letters of both cases (or letters and
digits) is random when it needs many tokens, under `MAX_RATIO` characters a token
by a tiktoken vocabulary, since names and words are in such a vocabulary and
random strings are not.  Each unbroken run is cut at its separators
(``. / _ = + -``); parts that need many tokens score their tokens against their
length, separators and short words their length, words of `MIN_WORD` or more end
a string.  Every maximal scoring segment of `MIN_LENGTH` or more characters is
tested (joined parts with one of `MIN_PART` or more, so keys that hold separators
stay whole), else each of its parts of `MIN_LENGTH` or more.  A run of `MIN_RUN` or more characters without
such a part is tested as a whole.  Known digests (hex of the lengths in
`DIGESTS`), UUIDs, numbers, compact dates with times, dotted or slashed names of
words and anything a fixed pattern has found are left out.  A part of letters of one
case (or capitalised) looks like a word, so it must be longer and need more tokens:
`LETTERS` or more, under `LETTERS_RATIO` characters a token, which no word of the
given texts does; shorter ones cannot be told from invented or compound words.
Random characters that no separator sets off from the words beside them are tested
with them.  The work is linear in a run's length, apart from sorting.

Positions are code points, ends exclusive.  Null is the empty text; repeated
rows give equal results; extra columns are ignored; an empty table gives no rows.
"""
from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.rows import keep_rows
from tollgate.llm.toxicity import segments
from tollgate.llm.vocabulary import vocabulary_path

KINDS = ("assign", "access", "hex", "random")
MIN_LENGTH = 16
MIN_RUN = 20
MIN_PART = 8
MIN_WORD = 4
MAX_RATIO = 2.3
LETTERS = 24
LETTERS_RATIO = 2.1
REMEMBERED = 100_000
#: Fixed patterns and least lengths.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_HINT = re.compile("passw|secret|token|api_?key", re.I | re.A)
_ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
_HEX = re.compile("[0-9a-f]{24,}")
_STRING = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{16,}(?![A-Za-z0-9+/_=.-])")
_PART = re.compile("(?<![A-Za-z0-9])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![A-Za-z0-9])|[A-Za-z0-9]+")
_LETTERS = re.compile("[a-z]+|[A-Z]+|[A-Z][a-z]+")
#: Lengths of hex digests (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512).
DIGESTS = (32, 40, 56, 64, 96, 128)
_KNOWN = re.compile("|".join([*(f"(?:[0-9a-f]{{{n}}}|[0-9A-F]{{{n}}})" for n in DIGESTS),
                              "[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", "[0-9.+=_/-]+", "[0-9]{8}T[0-9]{4,9}Z?",
                              "(?:[A-Za-z][a-z]*|[A-Z]+|[0-9]+)(?:[./_=-]+(?:[A-Za-z][a-z]*|[A-Z]+|[0-9]+))*[./_=-]*"]))


@cache
def _encoding(name: str):
    import public_tokenizers
    import tiktoken

    with open(vocabulary_path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _mixed(s: str) -> bool:
    return sum(bool(re.search(c, s)) for c in ("[a-z]", "[A-Z]", "[0-9]")) >= 2


class Finder:
    def __init__(self, vocabulary: str, max_ratio: float):
        self.encoding, self.max_ratio = _encoding(vocabulary), max_ratio
        self.known: dict[str, float] = {}

    def score(self, s: str) -> float:
        """Positive if *s* needs many tokens; minus its length if it is of a known form."""
        if s not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[s] = -len(s) if _KNOWN.fullmatch(s) else self.max_ratio * len(self.encoding.encode_ordinary(s)) - len(s)
        return self.known[s]

    def is_random(self, s: str) -> bool:
        return _mixed(s) and self.score(s) > 0

    def random_letters(self, s: str) -> bool:
        return len(s) >= LETTERS and bool(_LETTERS.fullmatch(s)) and LETTERS_RATIO * len(self.encoding.encode_ordinary(s)) > len(s)

    def random_spans(self, s: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """(start, end) of random strings of one run, clear of the spans *taken* (sorted)."""
        starts = [b for b, _ in taken]
        reach = list(accumulate((e for _, e in taken), max))

        def is_clear(b: int, e: int) -> bool:
            k = bisect_left(starts, e)
            return not k or reach[k - 1] <= b

        parts = [m.span() for m in _PART.finditer(s)]
        letters = [(b, e) for b, e in parts if e - b >= LETTERS and self.random_letters(s[b:e]) and is_clear(b, e)]
        if not _mixed(s) or _KNOWN.fullmatch(s):
            return letters

        def is_found(b: int, e: int) -> bool:
            return is_clear(b, e) and self.is_random(s[b:e])

        scores = np.zeros(2 * len(parts))  # each part, then the separators after it
        scores[::2] = [x if x > 0 or e - b < MIN_WORD else -self.max_ratio * len(s) for b, e in parts for x in [self.score(s[b:e])]]
        scores[1:-1:2] = [e - b for (_, e), (b, _) in zip(parts, parts[1:], strict=False)]
        out = []
        for first, last, _ in segments(scores):
            inside = parts[first // 2 : (last + 1) // 2]
            begin, end = inside[0][0], inside[-1][1]
            if end - begin >= MIN_LENGTH and (len(inside) == 1 or any(e - b >= MIN_PART and self.score(s[b:e]) > 0 for b, e in inside)) and is_found(begin, end):
                out.append((begin, end))
            elif len(inside) > 1:
                out += [(b, e) for b, e in inside if e - b >= MIN_LENGTH and is_found(b, e)]
        if not out and not letters:
            return [(0, len(s))] if len(s) >= MIN_RUN and is_found(0, len(s)) else []
        return sorted(out + [(b, e) for b, e in letters if not any(x < e and b < y for x, y in out)])

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """(start, kind, end), sorted; kind is an index of KINDS."""
        if not text:
            return []
        out = []
        if _ASSIGN_HINT.search(text):
            out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
        if "AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
        out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
        base, k, near = sorted(out), 0, []
        for m in _STRING.finditer(text):
            at = m.start()
            near = [x for x in near if x[2] > at]
            while k < len(base) and base[k][0] < m.end():
                near, k = near + [base[k]] * (base[k][2] > at), k + 1
            out += [(at + b, 3, at + e) for b, e in self.random_spans(m[0], [(b - at, e - at) for b, _, e in near])]
        return sorted(out)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str = "byte_bpe_50k.tiktoken",
                 max_ratio: float = MAX_RATIO) -> DataFrame:
    """One row per row of *docs*: the id, counts of the fixed kinds (n_assign, n_access, n_hex) and of the added one
    (n_random), the SHA-256 of the fixed spans joined as ``kind:start:end``, and all spans joined likewise."""

    def run(batches):
        finder = Finder(vocabulary, max_ratio)
        for batch in batches:
            found = [finder.spans(t.as_py()) for t in batch.column(1)]
            counts = [pa.array([sum(x[1] == k for x in f) for f in found], pa.int64()) for k in range(4)]
            digest = [hashlib.sha256(joined(x for x in f if x[1] < 3).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(digest, pa.string()), pa.array(map(joined, found), pa.string())],
                                             names=["doc", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("body"))
    out = rows.mapInArrow(run, "doc long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")
    return out.withColumnRenamed("doc", id_col)


def keep_clean(docs: DataFrame, text_col: str = "text", *, vocabulary: str = "byte_bpe_50k.tiktoken", max_ratio: float = MAX_RATIO) -> DataFrame:
    """The rows of *docs* without a span of any kind (all columns, in one pass over the table)."""

    def judge():
        finder = Finder(vocabulary, max_ratio)
        return lambda texts: [not finder.spans(t.as_py()) for t in texts]

    return keep_rows(docs, text_col, judge)
