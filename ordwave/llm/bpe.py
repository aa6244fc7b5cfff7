"""Byte-level BPE encoding and decoding by monoid tree reduction.

A piece of text is halved down to single bytes, which are tokens. Two
neighbours are joined by encoding anew a window of tokens around the seam (lowest
rank first, leftmost on ties), growing it until the tokens next to the window
provably stay: a token sequence is the BPE encoding of its bytes if and only if
each adjacent pair is the encoding of its own two tokens' bytes, so only the
two pairs at the window's ends have to be checked. The encodings of short halves,
of windows and of pairs recur in all pieces and are remembered, as whole
pieces are. Decoding concatenates neighbours up the tree, level by level.

Defined results: a null text counts as empty (no tokens); repeated rows and
repeated ids each give their own row; an empty table gives no rows; other
columns of the input are ignored. Very long texts are split by the pattern
piece by piece, so memory beyond the text is bounded.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import islice
from operator import add
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SCAN = 48            # bytes of a window up to which its lowest pair is found by scanning
HALF = 8             # bytes up to which the encoding of a half is remembered
CACHE = 100_000      # entries of each memory of a task process; dropped when full (speed only)
RUN = 200_000        # pieces encoded at a time within one text


class Bpe:
    """Ranks from a file of ``base64(token) rank`` lines."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        size = max(self.ranks.values()) + 1
        self.tokens = [b""] * size
        for t, r in self.ranks.items():
            self.tokens[r] = t
        # the library's \s is the White_Space property; spell it so that no other control counts
        self.pattern = regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]")
                                     .replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self._pairs: dict[int, tuple | None] = {}
        self._halves: dict[bytes, tuple] = {}
        self._pieces: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}          # pieces of the generation before

    # -- encoding -----------------------------------------------------------
    def merge(self, data: bytes) -> list[bytes]:
        """Direct merging of a short window."""
        parts = [data[i : i + 1] for i in range(len(data))]
        get = self.ranks.get
        ranks = [get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, r in enumerate(ranks):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = get(parts[at] + parts[at + 1])
            if at:
                ranks[at - 1] = get(parts[at - 1] + parts[at])

    def merge_long(self, data: bytes) -> list[bytes]:
        """Direct merging with a heap, for windows of any length."""
        if len(data) <= SCAN:
            return self.merge(data)
        n = len(data)
        end = list(range(1, n + 1))
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := self.ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, mid, stop = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if not alive[i] or end[i] != mid or j >= n or end[j] != stop:
                continue
            end[i], nxt[i], alive[j] = stop, nxt[j], False
            if nxt[i] < n:
                prev[nxt[i]] = i
                k = nxt[i]
                if (r := self.ranks.get(data[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i, stop, end[k]))
            if (p := prev[i]) >= 0 and (r := self.ranks.get(data[p:stop])) is not None:
                heapq.heappush(heap, (r, p, i, stop))
        out, i = [], 0
        while i < n:
            out.append(data[i : end[i]])
            i = nxt[i]
        return out

    def window(self, tokens) -> tuple:
        """Encoding of the bytes of some tokens."""
        return tuple(map(self.ranks.__getitem__, self.merge_long(b"".join(map(self.tokens.__getitem__, tokens)))))

    def pair(self, a: int, b: int) -> tuple | None:
        """None if ``a`` and ``b`` side by side stay two tokens, else the
        encoding of their bytes."""
        key = a << 32 | b
        known = self._pairs.get(key, 0)
        if known == 0:
            if len(self._pairs) > CACHE:
                self._pairs.clear()
            known = self.window((a, b))
            known = self._pairs[key] = None if known == (a, b) else known
        return known

    def join(self, a: tuple, b: tuple) -> tuple:
        """Encoding of the two encoded strings' concatenation."""
        if not a or not b:
            return a + b
        mid = self.pair(a[-1], b[0])
        if mid is None:
            return a + b
        k = 1
        while True:
            i, j = max(0, len(a) - k), min(len(b), k)
            if (not i or self.pair(a[i - 1], mid[0]) is None) and (j == len(b) or self.pair(mid[-1], b[j]) is None):
                return a[:i] + mid + b[j:]
            k *= 2
            mid = self.window(a[-k:] + b[:k])

    def tree(self, data: bytes) -> tuple:
        if len(data) <= 1:
            return (self.ranks[data],) if data else ()
        known = self._halves.get(data)
        if known is None:
            mid = len(data) // 2
            known = self.join(self.tree(data[:mid]), self.tree(data[mid:]))
            if len(data) <= HALF:
                if len(self._halves) > CACHE:
                    self._halves.clear()
                self._halves[data] = known
        return known

    def piece_ids(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.ranks.get(data)
        ids = (whole,) if whole is not None else self.tree(data)
        return pack(f"<{len(ids)}I", *ids)

    def encode_runs(self, text: str) -> Iterator[bytes]:
        """Ids as little-endian unsigned 32-bit integers, some pieces at a time."""
        found = iter([self.pattern.findall(text)]) if len(text) < 2 * RUN else self._runs(text)
        for pieces in found:
            if len(self._pieces) > CACHE:
                self._older, self._pieces = self._pieces, {}
            known, older = self._pieces, self._older
            for p in set(pieces).difference(known):
                raw = older.get(p)
                known[p] = self.piece_ids(p) if raw is None else raw
            yield b"".join(map(known.__getitem__, pieces))

    def _runs(self, text: str) -> Iterator[list[str]]:
        it = (m.group() for m in self.pattern.finditer(text))
        while pieces := list(islice(it, RUN)):
            yield pieces

    # -- decoding -----------------------------------------------------------
    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids, neighbours concatenated up the tree."""
        parts = list(map(self.tokens.__getitem__, ids))
        while len(parts) > 1:
            odd = parts[len(parts) & ~1 :]
            parts = list(map(add, parts[::2], parts[1::2])) + odd
        return parts[0] if parts else b""


_loaded: dict[tuple[str, str], Bpe] = {}


def loaded(path: str, pattern: str) -> Bpe:
    """The tokenizer, read once per process."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Bpe(path, pattern)
    return _loaded[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True) -> DataFrame:
    """Encode and decode each text: ``id_col``, ``n_tokens``, ``ids_sha256``,
    ``decoded_sha256`` and, if asked for, ``ids`` (array of int)."""
    def run(batches):
        bpe = loaded(path, pattern)
        for batch in batches:
            n, ids_sha, dec_sha, all_ids = [], [], [], []
            for text in batch.column(1).to_pylist():
                h, d, total, kept = hashlib.sha256(), hashlib.sha256(), 0, []
                for raw in bpe.encode_runs(text or ""):
                    h.update(raw)
                    ids = np.frombuffer(raw, "<u4")
                    total += len(ids)
                    d.update(bpe.decode(ids.tolist()))
                    if with_ids:
                        kept.append(ids.astype(np.int32))
                n.append(total)
                ids_sha.append(h.hexdigest())
                dec_sha.append(d.hexdigest())
                if with_ids:
                    all_ids.append(np.concatenate(kept) if kept else np.zeros(0, np.int32))
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(dec_sha)]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    src = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("__text"))
    kind = src.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return src.mapInArrow(run, schema)
