"""Subword ids of texts by a public tokenizer, with a bounded memory of words.

The tokenizer's white space and its pieces never cross ASCII white space, so a text's ids are those of
its words in a row. Words of plain letters, with or without punctuation behind them, go straight to the
tokenizer's model, others through the whole tokenizer, and a text that may hold the tokenizer's special
strings goes through it as a whole.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache

import numpy as np

#: Words, and parts of words, whose ids a worker remembers: those of the present and of the last so many new ones.
REMEMBERED = 250_000
#: Letters that lower-casing and composing leave alone, then ASCII punctuation without apostrophe and <.
PLAIN_ASCII = re.compile(rb"([A-Za-z]*)([!-&(-/:;=-@\[-`{-~]*)").fullmatch
PLAIN = re.compile(r"([a-zß-öø-ÿ]*)([!-&(-/:;=-@\[-`{-~]*)")


def byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: printable ones themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class TextIds:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = byte_letters()
        self.words: dict[bytes, bytes] = {}
        self.old_words: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {b"": b""}
        self.old_parts: dict[bytes, bytes] = {}
        self.tokenize = self.tokenizer.model.tokenize

    def part(self, piece: bytes) -> bytes:
        known = self.parts.get(piece)
        if known is not None:
            return known
        known = self.old_parts.get(piece)
        if known is None:
            mapped = piece.decode() if piece.isascii() else "".join(self.letters[b] for b in piece)
            found = self.tokenize(mapped)
            known = struct.pack(f"<{len(found)}H", *[t.id for t in found])
        if len(self.parts) >= REMEMBERED:
            self.parts, self.old_parts = {b"": b""}, self.parts
        self.parts[piece] = known
        return known

    def word(self, word: bytes) -> bytes:
        plain = PLAIN_ASCII(word)
        if plain:
            letters, marks = plain.groups()
            letters = letters.lower()
            one, two = self.parts.get(letters), self.parts.get(marks)
            if one is not None and two is not None:
                return one + two
        else:
            text = word.decode()
            found = PLAIN.fullmatch(text.lower())
            if not found or len(text) != len(found.group()):
                return self.whole(text)
            letters, marks = (part.encode() for part in found.groups())
        return self.part(letters) + self.part(marks)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def ids(self, text: bytes) -> bytes:
        """The ids of a UTF-8 text as little-endian unsigned 32-bit numbers."""
        return np.frombuffer(self.short_ids(text), dtype="<u2").astype("<u4").tobytes()

    def short_ids(self, text: bytes) -> bytes:
        """The same in 16 bits, which hold every id of these vocabularies."""
        if b"<|" in text:
            return self.whole(text.decode())
        if len(self.words) >= REMEMBERED:
            self.words, self.old_words = {}, self.words
        known, old, words = self.words, self.old_words, text.split()
        found = list(map(known.get, words))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            word = words[i]
            ids = old.get(word)
            found[i] = known[word] = self.word(word) if ids is None else ids
        return b"".join(found)


@lru_cache(maxsize=2)
def text_ids(path: str) -> TextIds:
    return TextIds(path)
