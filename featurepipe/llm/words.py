"""Vectorised words of whole texts: Arrow string arrays in, numpy arrays out.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. UTF-8
keeps those bytes out of longer characters, so bytes and code points agree. A
null text has no words. Work goes in pieces of about ``CHUNK`` bytes (at least
one text), so memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 19
U = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x + U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE = mix(np.arange(256, dtype=U)) | U(1)
PLACE = mix(np.arange(1 << 12, dtype=U) + U(1 << 20)) | U(1)


def place(n: int) -> np.ndarray:
    """Weights of the first ``n`` byte positions of a word."""
    return PLACE if n <= len(PLACE) else mix(np.arange(n, dtype=U) + U(1 << 20)) | U(1)


def chunks(text: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of pieces of the array; nulls read as empty."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    if not len(text):
        return
    _, off, data = text.buffers()
    off = np.frombuffer(off, np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(text):
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def word_hashes(data: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word in order, index of its text)."""
    inside = np.flatnonzero(~SPACE[data])
    if not len(inside):
        return np.empty(0, U), np.empty(0, np.int64)
    first = np.empty(len(inside), bool)
    first[0] = True
    first[1:] = np.diff(inside) > 1
    cut = np.searchsorted(inside, off[:-1])  # the first byte at or after each text's start
    first[cut[cut < len(inside)]] = True
    at = np.flatnonzero(first)
    size = np.diff(np.append(at, len(inside)))
    pos = np.arange(len(inside)) - np.repeat(at, size)
    chars = data[inside]
    h = np.add.reduceat(BYTE[LOWER[chars] if lower else chars] * place(int(size.max()))[pos], at)
    return mix(h ^ (size.astype(U) << U(48))), np.searchsorted(off, inside[at], side="right") - 1


def shingles(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(62-bit hash of each k-word window, index of its text); a text of fewer words is one window."""
    if not len(h):
        return h, doc
    n_doc = int(doc[-1]) + 1
    count = np.bincount(doc, minlength=n_doc)
    full = np.zeros(max(0, len(h) - k + 1), U)
    for i in range(k):
        full = mix(full ^ h[i : len(h) - k + 1 + i]) if len(full) else full
    keep = doc[: len(full)] == doc[k - 1 :] if len(full) else np.empty(0, bool)
    out, of = [full[keep]], [doc[: len(full)][keep]]
    start = np.concatenate(([0], np.cumsum(count)[:-1]))
    for m in range(1, k):  # short texts: all their words, tagged with the count
        short = np.flatnonzero(count == m)
        if len(short):
            s = np.full(len(short), m, U)
            for i in range(m):
                s = mix(s ^ h[start[short] + i])
            out.append(mix(s))
            of.append(short)
    return np.concatenate(out) >> U(2), np.concatenate(of)


def distinct(h: np.ndarray, doc: np.ndarray, n_doc: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values per text, ascending, and the offsets of the texts in them."""
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], np.searchsorted(doc[keep], np.arange(n_doc + 1))


def shingle_sets(text: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, values, offsets) per piece: each text's distinct k-word shingles, ascending."""
    for i, j, data, off in chunks(text):
        h, doc = word_hashes(data, off)
        yield i, *distinct(*shingles(h, doc, k), j - i)
