"""Numpy text primitives for Arrow batches, used inside tasks.

Words are runs of bytes outside a separator set, so UTF-8 needs no decoding.
A word's key is a polynomial hash read off a prefix sum: the sum of
``T[byte] * B**position`` over the word, divided by ``B**start`` (modulo
2**64, ``B`` odd), then mixed. Work is done in blocks of about ``BLOCK``
bytes, so memory does not grow with the Arrow batch; a single longer text
gets a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
U = np.uint64
_B = U(0x9E3779B97F4A7C15)
_B_INV = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def byte_table(lower: bool) -> np.ndarray:
    t = np.random.default_rng(20240607).integers(1, 1 << 62, 256, dtype=np.uint64) * U(2) + U(1)
    if lower:
        t[65:91] = t[97:123]
    return t


LOWER, EXACT = byte_table(True), byte_table(False)
WHITE = np.zeros(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[65:91] = NOT_LETTER[97:123] = NOT_LETTER[128:] = False

_pow = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow[0]) < n + 1:
        size = max(n + 1, BLOCK + 1)
        for k, b in enumerate((_B, _B_INV)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _pow[k] = np.cumprod(p)
    return _pow[0], _pow[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@dataclass
class Block:
    """Texts ``first .. first + len(bounds) - 1`` of a batch: their bytes back
    to back, and the bounds of each."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def runs(self, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of each run of bytes not in ``sep``."""
        w = ~sep[self.data]
        if not w.any():
            z = np.zeros(0, np.int64)
            return z, z, z
        lo, hi = self.bounds[:-1], self.bounds[1:]
        full = hi > lo
        st, en = w.copy(), w.copy()
        st[1:] &= ~w[:-1]
        en[:-1] &= ~w[1:]
        st[lo[full]] = w[lo[full]]
        en[hi[full] - 1] = w[hi[full] - 1]
        starts, ends = np.flatnonzero(st), np.flatnonzero(en) + 1
        return starts, ends, np.searchsorted(self.bounds, starts, side="right") - 1

    def prefix(self, values: np.ndarray) -> np.ndarray:
        p, _ = _powers(len(self.data))
        out = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(values[self.data] * p[: len(self.data)], out=out[1:])
        return out


def span_keys(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed hash of the bytes in each span."""
    _, inv = _powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * inv[starts])


def windows(keys: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive keys."""
    if len(keys) < size:
        return np.zeros(0, np.uint64)
    n = len(keys) - size + 1
    out = keys[:n].copy()
    for j in range(1, size):
        out = mix(out * U(3) + keys[j : j + n])
    return out


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 bounds of a string column; null counts as empty."""
    arr = col.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    _, off, data = arr.buffers()
    bounds = np.frombuffer(off, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, bounds


def blocks(col: pa.Array) -> Iterator[Block]:
    """Cut a string column into blocks of whole texts."""
    if not len(col):
        return
    raw, bounds = text_bytes(col)
    i, n = 0, len(bounds) - 1
    while i < n:
        j = int(np.searchsorted(bounds, bounds[i] + BLOCK, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield Block(i, raw[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
        i = j


def doc_slices(owner: np.ndarray, n: int) -> np.ndarray:
    """Bounds of each text's entries in an array sorted by owner."""
    return np.searchsorted(owner, np.arange(n + 1))


def shingle_sets(block: Block, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word shingles of each text (lower-cased A-Z), sorted by
    (text, key), with the text number of each. A text with fewer words has
    its whole sequence as one shingle; one without words has none."""
    starts, ends, owner = block.runs(WHITE)
    keys = span_keys(block.prefix(LOWER), starts, ends)
    at = doc_slices(owner, len(block.bounds) - 1)
    w = windows(keys, size)
    inside = owner[: len(w)] == owner[size - 1 : size - 1 + len(w)] if len(w) else np.zeros(0, bool)
    vals, docs = w[inside], owner[: len(w)][inside]
    count = np.diff(at)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        extra = mix(count[short].astype(np.uint64) + U(0x51ED))
        for j in range(size - 1):
            more = count[short] > j
            extra[more] = mix(extra[more] * U(3) + keys[at[short[more]] + j])
        vals, docs = np.concatenate((vals, extra)), np.concatenate((docs, short))
    order = np.lexsort((vals, docs))
    vals, docs = vals[order], docs[order]
    if len(vals):
        new = np.ones(len(vals), bool)
        new[1:] = (vals[1:] != vals[:-1]) | (docs[1:] != docs[:-1])
        vals, docs = vals[new], docs[new]
    return vals, docs
