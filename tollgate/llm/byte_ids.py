"""Token ids of whole texts for byte-level vocabularies, a run between spaces at a time.

Such a vocabulary joins a space to the word after it, so a pre-token begins at
every space that stands before something other than white space.  A text is cut
there and the ids of each run are remembered; a new run is put together from its
pre-tokens, whose ids come from the library's own model.  Texts with a space
before white space or at their end, with other than Latin letters or with strings
of special tokens go through the library whole, and so do all texts if the
vocabulary's file splits or normalises texts in another way.
"""
from __future__ import annotations

import json
import re
import struct
from functools import cache

from tollgate.llm.token_count import LATIN, PRE_TOKEN_LATIN
from tollgate.llm.vocabulary import byte_letters, load_tokenizer

_LOOSE = re.compile(r"\x20(?:\s|\Z)")
_KEEP_CHARS = 64  # longer runs are not remembered


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class ByteIds(dict):
    """run -> ids of it with a space before, as bytes; forgets everything when *limit* runs are held.  Strings of special
    tokens are one id each, as in the library's default."""

    def __init__(self, name: str, limit: int = 500_000):
        super().__init__()
        self.tokenizer, self.limit = load_tokenizer(name), limit
        self.model = self.tokenizer.model
        self.letters = {b: c for b, c in byte_letters().items() if chr(b) != c}
        self.space = self.letters[0x20]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.latin, self.split = re.compile(LATIN), re.compile(PRE_TOKEN_LATIN)
        spec = json.loads(self.tokenizer.to_str())
        before = spec["pre_tokenizer"] or {}
        self.known_split = (not spec["normalizer"] and spec["model"]["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                            and not before.get("add_prefix_space"))

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _pre_token(self, piece: str) -> bytes:
        mapped = piece.encode().decode("latin-1").translate(self.letters)
        return _packed([t.id for t in self.model.tokenize(mapped)])

    def __missing__(self, run: str) -> bytes:
        if run.isalpha():
            ids = _packed([t.id for t in self.model.tokenize(self.space + run)]) if run.isascii() else self._pre_token(" " + run)
        else:
            ids = b"".join([self[x[1:]] if x[0] == " " and x[1:].isalpha() else self._pre_token(x) for x in self.split.findall(" " + run)])
        if len(run) <= _KEEP_CHARS:
            if len(self) >= self.limit:
                self.clear()
            self[run] = ids
        return ids

    def of(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids, without added special tokens; empty for null."""
        if not text:
            return b""
        if not self.known_split or _LOOSE.search(text) or not self.latin.fullmatch(text) or any(s in text for s in self.special):
            return self._whole(text)
        first, *rest = text.split(" ")
        return (self._whole(first) if first else b"") + b"".join(map(self.__getitem__, rest))


@cache
def byte_ids(name: str) -> ByteIds:
    """One for each worker process, so that later tasks find what earlier ones have learned."""
    return ByteIds(name)
