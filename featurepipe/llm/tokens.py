"""Token ids of whole texts with the tokenizers library, through a cache of words.

A vocabulary whose rules put text in lower case and split it at white space before
merging gives a text the ids of its space-separated words one after the other, and a word those of its
pieces (letters, digits, punctuation). Words and pieces already met are looked up;
for a new piece the library's model does the merging. That holds for texts of plain
characters (all but ``OTHER``: normalisation changes nothing but case there); every
other text, one that spells a special token, and all texts under a vocabulary of another kind
(told by a probe when it is loaded) are encoded whole by the library.
Both caches are bounded by their bytes: once full they take no more entries (frequent words come
early) and the rest is encoded each time.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

DEFAULT_VOCABULARY = "word_bpe_49k.json"
CACHE_BYTES = 80 << 20  # of each cache, about
LONG_WORD = 64  # longer words are not kept
PROBE = "The quick-brown fox isn't 12,5 % of 'A B' e.g. x_y (z)... I'LL we've\tend\n"

# what is not ASCII (without the separators 0x1C-0x1F), a precomposed Latin letter or common punctuation
OTHER = re.compile(r"[^\x00-\x1b\x20-\x7e¡§«°·»¿À-įı-ňŊ-ž‐-‧€]|<\|")
ODD = ("<|", "\x1c", "\x1d", "\x1e", "\x1f", "\x7f")
# the split pattern of the vocabulary (a fixed value), over lower-case plain characters
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+").findall


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


LETTERS = _byte_letters()


class _Cache(dict):
    """Ids by word or piece; what comes after the bound is made each time."""

    def __init__(self, make):
        self.make, self.room = make, CACHE_BYTES

    def __missing__(self, key: str) -> bytes:
        ids = self.make(key)
        size = 140 + len(key) + len(ids)
        if self.room >= size and len(key) <= LONG_WORD:
            self.room -= size
            self[key] = ids
        return ids


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes; a null text has none."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.model._resize_cache(0)  # pieces come here once
        tokenize = self.library.model.tokenize

        def merged(piece: str) -> bytes:
            letters = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(LETTERS)
            return np.array([t.id for t in tokenize(letters)], "<u4").tobytes()

        self.pieces = _Cache(merged)
        piece = self.pieces.__getitem__
        self.words = _Cache(lambda word: b"".join(map(piece, PIECES(word))))
        self.by_words = self._spells("A") == self._spells("a") and self._joined(PROBE) == self._spells(PROBE)

    def _spells(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _joined(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, text.lower().split()))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_words or (not (text.isascii() and not any(c in text for c in ODD)) and OTHER.search(text)):
            return self._spells(text)
        return self._joined(text)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    return Encoder(path)
