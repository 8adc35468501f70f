"""Vocabulary files of public tokenizers, and word-wise token ids with them.

A vocabulary is named by a path, or by a file name that the installed
``public_tokenizers`` package resolves on each worker; files are never copied.
"""
from __future__ import annotations

import json
import os
import re
from functools import cache

import numpy as np


def vocabulary_path(name: str) -> str:
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 as is, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    odd = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(odd)}


@cache
def load_tokenizer(name: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path(name))


class WordIds(dict):
    """Token ids of whole texts for a BPE whose pre-tokens are words without white space and whose tokens end
    words (``</w>``).  Ids of a word come from the library's own BPE model and are remembered, so a repeated
    word costs one lookup; texts with characters outside Latin (`PLAIN`) or with strings of special tokens go
    through the library whole.  Holds at most *limit* words.
    """

    #: Characters for which lower-casing and composition are the same character by character.
    PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-įı-ɏ]*")
    #: The vocabulary's own split pattern over those characters, lower-cased: a fixed value.
    PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-ɏ]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|"
                        "[^\\s0-9a-z\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-ɏ]+")

    def __init__(self, name: str, limit: int = 400_000):
        super().__init__()
        self.tokenizer, self.limit = load_tokenizer(name), limit
        self.model = self.tokenizer.model
        self.letters = {b: c for b, c in byte_letters().items() if chr(b) != c}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(vocabulary_path(name), encoding="utf-8") as f:
            words = json.load(f)["model"]["vocab"]
        ends = [i for w, i in words.items() if re.fullmatch(r"[.!?…]+[\"')\]]*</w>", w)]
        self.sentence_end = np.zeros(max(words.values()) + 3, bool)
        self.sentence_end[ends] = True

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        mapped = piece.encode().decode("latin-1").translate(self.letters)
        self[piece] = ids = np.array([t.id for t in self.model.tokenize(mapped)], "<u4").tobytes()
        return ids

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids, without special tokens; empty for null."""
        if not text:
            return b""
        if self.PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return b"".join(map(self.__getitem__, self.PIECES.findall(text.lower())))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
