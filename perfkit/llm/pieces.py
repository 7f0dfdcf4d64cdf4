"""Encoding texts piece by piece with bounded memo tables.

A split pattern cuts a text into pieces that are encoded separately. A single space or line break
between two printing characters is always a cut, so regular texts are first split there by plain
string operations, and whole chunks are looked up; the pattern runs on unknown chunks only. Texts
with any other white space, or with characters whose class depends on a Unicode version, take the
general path.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from itertools import islice

import regex

from perfkit.llm.common import ship

#: Entries of one generation of a memo table.
MEMO = 500_000
#: Longer pieces are not kept in the memo.
MEMO_CHARS = 64
#: Characters, or pieces, handled at a time.
STREAM = 1 << 18

#: Characters other than these make a text irregular, and so does white space next to white space.
_ODD = re.compile("[^\\x20-\\x7E\\n\\u00A1-\\u024F]")
_PAIRS = ("  ", "\n\n", " \n", "\n ")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class Memo(dict):
    """A bounded table in two generations: what is still in use outlives a full table."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > MEMO_CHARS:
                return value
        self.keep(key, value)
        return value

    def keep(self, key: str, value: bytes) -> None:
        if len(self) >= MEMO:
            self.older = dict(self)
            self.clear()
        self[key] = value


class TextEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, pattern: str, encode_piece: Callable[[str], list[int]],
                 encode_odd: Callable[[str], list[int]] | None = None,
                 encode_words: Callable[[list[str]], list[bytes]] | None = None):
        """``encode_odd`` encodes a whole irregular text; by default its pieces are looked up.
        ``encode_words`` gives the ids of many words, each after a space, in one call."""
        self.split = regex.compile(pattern)
        self.formats = [struct.Struct(f"<{n}I") for n in range(32)]
        self.encode_piece = encode_piece
        self.pieces = Memo(self._piece)
        self.chunks = Memo(self._chunk)
        self.encode_odd = encode_odd
        self.encode_words = encode_words

    def _packed(self, ids: list[int]) -> bytes:
        n = len(ids)
        return self.formats[n].pack(*ids) if n < len(self.formats) else struct.pack(f"<{n}I", *ids)

    def _piece(self, piece: str) -> bytes:
        return self._packed(self.encode_piece(piece))

    def _chunk(self, chunk: str) -> bytes:
        """A chunk that begins with a line break stands as it is, any other follows a space. A word is
        one piece, and so are the marks that follow it."""
        if chunk.isalpha():
            return self._piece(" " + chunk)
        if chunk[0] != "\n":
            word = chunk.rstrip(_MARKS)
            if word.isalpha():
                return self.chunks[word] + self.pieces[chunk[len(word):]]
            chunk = " " + chunk
        return b"".join(map(self.pieces.__getitem__, self.split.findall(chunk)))

    def _meet(self, chunks: list[str]) -> None:
        """Puts the words among ``chunks`` that the memo lacks there, all at once."""
        known, older = self.chunks, self.chunks.older
        new = {c if c.isalpha() else c.rstrip(_MARKS) for c in set(chunks) if c not in known and c not in older}
        words = [w for w in new if w.isalpha() and len(w) <= MEMO_CHARS and w not in known and w not in older]
        if words:
            for word, ids in zip(words, self.encode_words(words)):
                known.keep(word, ids)

    @staticmethod
    def regular(text: str) -> bool:
        return not (text[:1] == " " or text[-1:] == " " or any(p in text for p in _PAIRS) or _ODD.search(text))

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of a text, in runs."""
        if not self.regular(text):
            if self.encode_odd is not None:
                yield self._packed(self.encode_odd(text))
                return
            found = (m.group() for m in self.split.finditer(text))
            while run := b"".join(map(self.pieces.__getitem__, islice(found, STREAM))):
                yield run
            return
        at, look = 0, self.chunks.__getitem__
        while at < len(text):
            end = text.find(" ", at + STREAM) if len(text) - at > STREAM else -1
            end = len(text) if end < 0 else end
            first, *rest = text[at:end].replace("\n", " \n").split(" ")
            if at:
                rest.insert(0, first)
            elif first:
                yield b"".join(map(self.pieces.__getitem__, self.split.findall(first)))
            if self.encode_words is not None:
                self._meet(rest)
            yield b"".join(map(look, rest))
            at = end + 1


ship(__name__)
