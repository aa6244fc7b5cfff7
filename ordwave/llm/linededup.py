"""Repeated passages by hashing normalised line units.

Lines are cut into units: a unit ends at a line's end, and after a word whose
hash says so (one in ``STEP``), so the same words are cut alike wherever they
stand, also inside another line. Words are lower-cased (A-Z) and white space
between them does not count. From each unit on, as many units as make
``LEAST`` words are hashed together; the digests are grouped globally. The
occurrence in the document of lowest id is kept (within a
document the first), and the others are removed if together they cover a run
of at least ``min_words`` words. With ``lines``, whole lines (their words) are
hashed too, and later copies of a line of ``line_words`` words or more are
removed wherever it stands. Removed spans keep their offsets in the
original text and the id of the document that keeps the passage.

Each task sends each of its digests once per document; digests are reduced to
their smallest document where they meet, and only later occurrences travel
back, as one array per document.

Defined results: a null text counts as empty; an id stands for one document,
so rows that repeat an id are treated alike; rows whose id is null, or no whole
number, rank last, by a hash of their text, and those of the same text count as one
document; ids are below 2^62; an empty table gives no rows; other columns are
passed through by :func:`clean` and ignored by :func:`repeats`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import packed
from .textnum import LOWER, U, WHITE, _B, _B_INV, Block, blocks, doc_slices, mix, span_keys

STEP = 3             # one in so many words ends a unit
LEAST = 6            # words that a digest covers at least, but at a text's end
MIN_WORDS = 30       # words that a removed run must cover
NO_ID = 1 << 62      # ranks of rows without an id start here


def rank(id_col: str, text_col: str):
    """What orders documents: the id, or without one a hash of the text."""
    by_text = F.lit(NO_ID) + F.xxhash64(F.col(text_col).cast("string")).bitwiseAND(F.lit((1 << 61) - 1))
    return F.coalesce(F.expr(f"try_cast(`{id_col}` AS bigint)"), by_text)


def unit_digests(block: Block):
    """Per run of units: digest, text number, first word and the word after
    its last; and the words' byte spans."""
    starts, ends, owner = block.runs(WHITE)
    none = np.zeros(0, np.int64)
    if not len(starts):
        return none.astype(np.uint64), none, none, none, starts, ends, owner
    keys = span_keys(block.prefix(LOWER), starts, ends)
    n = len(keys)
    lines = np.concatenate(([0], np.cumsum(block.data == 10)))
    stop = (keys >> U(40)) % U(STEP) == 0
    stop[:-1] |= (lines[starts[1:]] > lines[ends[:-1]]) | (owner[1:] != owner[:-1])
    stop[-1] = True
    last = np.flatnonzero(stop)                      # last word of each unit
    first = np.concatenate(([0], last[:-1] + 1))
    # from each unit's start to the first unit end at least LEAST words on, or the text's end
    end = doc_slices(owner, len(block.bounds) - 1)[owner[first] + 1]
    a = first
    b = np.minimum(last[np.minimum(np.searchsorted(last, first + LEAST - 1), len(last) - 1)] + 1, end)
    p, q = np.full(n + 1, _B, np.uint64), np.full(n + 1, _B_INV, np.uint64)
    p[0] = q[0] = 1
    p, q = np.cumprod(p), np.cumprod(q)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(keys * p[:n])))
    digest = mix((total[b] - total[a]) * q[a] + (b - a).astype(np.uint64))
    return digest, owner[a], a, b, starts, ends, owner


def digests(block: Block, lines: int):
    """As ``unit_digests``, with whole lines of ``lines`` words or more (0: none),
    by text; and which of the digests are lines."""
    digest, owner, a, b, starts, ends, word_owner = unit_digests(block)
    whole = np.zeros(len(digest), bool)
    if lines and len(starts):
        keys = span_keys(block.prefix(LOWER), starts, ends)
        n = len(keys)
        breaks = np.concatenate(([0], np.cumsum(block.data == 10)))
        new = np.ones(n, bool)
        new[1:] = (breaks[starts[1:]] > breaks[ends[:-1]]) | (word_owner[1:] != word_owner[:-1])
        x = np.flatnonzero(new)
        y = np.append(x[1:], n)
        place = np.arange(n, dtype=np.uint64) - np.repeat(x, y - x).astype(np.uint64)
        # mixed twice: a line's digest is not that of a run of units
        line = mix(mix(np.add.reduceat(mix(keys + place * _B), x)) + (y - x).astype(np.uint64))
        long = y - x >= lines
        x, y, line = x[long], y[long], line[long]
        digest, owner, a, b = (np.concatenate(z) for z in ((digest, line), (owner, word_owner[x]), (a, x), (b, y)))
        whole = np.concatenate((whole, np.ones(len(x), bool)))
        order = np.argsort(owner, kind="stable")
        digest, owner, a, b, whole = (z[order] for z in (digest, owner, a, b, whole))
    return digest, owner, a, b, starts, ends, word_owner, whole


def later_copies(docs: DataFrame, id_col: str, text_col: str, lines: int = 0) -> DataFrame:
    """``doc``, ``digests``, ``keepers``: of each document, the digests whose
    lowest document is another, and that document."""
    bits = packed.bucket_bits(docs)

    def emit(batches):
        held, count = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for b in blocks(batch.column(1)):
                digest, owner, *_ = digests(b, lines)
                held.append((digest, ids[b.first + owner]))
                count += len(digest)
                if count >= packed.FLUSH:
                    yield flush(held)
                    held, count = [], 0
        if held:
            yield flush(held)

    def flush(held):
        digest, doc = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((doc, digest))
        digest, doc = digest[order], doc[order]
        new = np.ones(len(digest), bool)
        new[1:] = (digest[1:] != digest[:-1]) | (doc[1:] != doc[:-1])
        rows = list(packed.pack(bits, digest[new], doc[new]))
        cols = list(zip(*rows)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())],
                                          ["bucket", "digests", "docs"])

    def gather(table):
        digest = packed.unpack(table.column("digests"), np.uint64)
        doc = packed.unpack(table.column("docs"), np.int64)
        order = np.lexsort((doc, digest))
        digest, doc = digest[order], doc[order]
        start = np.flatnonzero(np.concatenate(([True], digest[1:] != digest[:-1]))) if len(digest) else np.zeros(0, np.int64)
        keeper = np.repeat(doc[start], np.diff(np.append(start, len(digest)))) if len(start) else doc
        later = doc != keeper
        digest, doc, keeper = digest[later], doc[later], keeper[later]
        order = np.argsort(doc, kind="stable")
        digest, doc, keeper = digest[order], doc[order], keeper[order]
        at = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))) if len(doc) else np.zeros(0, np.int64)
        off = pa.array(np.append(at, len(doc)), pa.int32())
        return pa.table({"doc": doc[at], "digests": pa.ListArray.from_arrays(off, pa.array(digest.view(np.int64))),
                         "keepers": pa.ListArray.from_arrays(off, pa.array(keeper))})

    src = docs.select(rank(id_col, text_col).alias("doc"), F.col(text_col).cast("string").alias("t"))
    met = (src.mapInArrow(emit, "bucket long, digests binary, docs binary").groupBy("bucket")
           .applyInArrow(gather, "doc long, digests array<long>, keepers array<long>"))
    return met.groupBy("doc").agg(F.flatten(F.collect_list("digests")).alias("digests"), F.flatten(F.collect_list("keepers")).alias("keepers"))


def _runs(a: np.ndarray, b: np.ndarray, keeper: np.ndarray, min_words: int) -> list[tuple[int, int, int]]:
    """Word runs covered by the given word spans, if long enough, with a keeper."""
    out = []
    lo, hi, who = None, None, []
    for x, y, k in zip(a.tolist(), b.tolist(), keeper.tolist()):
        if lo is not None and x <= hi:
            hi = max(hi, y)
            who.append(k)
            continue
        if lo is not None and hi - lo >= min_words:
            out.append((lo, hi, min(who)))
        lo, hi, who = x, y, [k]
    if lo is not None and hi - lo >= min_words:
        out.append((lo, hi, min(who)))
    return out


def _join(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans in order, those that overlap as one; lines next to each other stay apart, as each has its keeper."""
    out = []
    for lo, hi, k in sorted(spans):
        if out and lo < out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]), min(k, out[-1][2]))
        else:
            out.append((lo, hi, k))
    return out


SPAN = "array<struct<start:bigint,end:bigint,kept_doc_id:bigint>>"


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, lines: bool = False, line_words: int = 1) -> DataFrame:
    """``id_col``, ``kept_text``, and ``removed``: spans (start, end in
    characters of the original, id of the keeper)."""
    return _mark(docs, id_col, text_col, min_words, [id_col], line_words if lines else 0).select(
        F.col("__0").alias(id_col), F.col("__kept").alias("kept_text"), F.col("__removed").alias("removed"))


def _mark(docs: DataFrame, id_col: str, text_col: str, min_words: int, keep: list[str], lines: int) -> DataFrame:
    """``__kept``, ``__removed`` and the ``keep`` columns as ``__0``, ``__1``
    and so on, so that no column of the input can clash."""
    later = later_copies(docs, id_col, text_col, lines)

    def run(batches):
        for batch in batches:
            ids, dig, kp = batch.column(0), batch.column(2), batch.column(3)
            texts, spans = [], []
            for b in blocks(batch.column(1)):
                digest, owner, a, e, starts, ends, _, whole = digests(b, lines)
                n = len(b.bounds) - 1
                at = doc_slices(owner, n)
                for d in range(n):
                    raw = b.data[b.bounds[d] : b.bounds[d + 1]]
                    mine = digest[at[d] : at[d + 1]]
                    row = b.first + d
                    known, who = np.zeros(0, np.uint64), np.zeros(0, np.int64)
                    if dig[row].is_valid:
                        known = dig[row].values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                        who = kp[row].values.to_numpy(zero_copy_only=False).astype(np.int64)
                        order = np.argsort(known)
                        known, who = known[order], who[order]
                    keeper = np.full(len(mine), ids[row].as_py(), np.int64)
                    hit = np.zeros(len(mine), bool)
                    if len(known) and len(mine):
                        p = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                        hit = known[p] == mine
                        keeper[hit] = who[p[hit]]
                    if len(mine) > 1:                 # a repeat within the text
                        order = np.argsort(mine, kind="stable")
                        hit[order[1:][mine[order][1:] == mine[order][:-1]]] = True
                    mine_a, mine_e, line = a[at[d] : at[d + 1]], e[at[d] : at[d + 1]], whole[at[d] : at[d + 1]]
                    unit = hit & ~line
                    runs = _runs(mine_a[unit], mine_e[unit], keeper[unit], min_words)
                    if lines:
                        line &= hit
                        runs = _join(runs + list(zip(mine_a[line].tolist(), mine_e[line].tolist(), keeper[line].tolist())))
                    if not runs:
                        texts.append(raw.tobytes())
                        spans.append([])
                        continue
                    chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                    left, pos, got = [], 0, []
                    for lo, hi, k in runs:
                        x, y = int(starts[lo] - b.bounds[d]), int(ends[hi - 1] - b.bounds[d])
                        got.append({"start": int(chars[x]), "end": int(chars[y]), "kept_doc_id": None if k >= NO_ID else k})
                        left.append(raw[pos:x].tobytes())
                        pos = y
                    left.append(raw[pos:].tobytes())
                    texts.append(b"".join(left))
                    spans.append(got)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kept_doc_id", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[4:], pa.array(texts, pa.binary()).cast(pa.string()), pa.array(spans, kind)],
                                             [*(f"__{i}" for i in range(len(keep))), "__kept", "__removed"])

    src = docs.select(rank(id_col, text_col).alias("doc"), F.col(text_col).cast("string").alias("__t"),
                      *(F.col(c).alias(f"__{i}") for i, c in enumerate(keep)))
    joined = src.join(later, "doc", "left").select("doc", "__t", "digests", "keepers", *(f"__{i}" for i in range(len(keep))))
    schema = ", ".join(f"__{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    return joined.mapInArrow(run, f"{schema}, __kept string, __removed {SPAN}")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, lines: bool = False, line_words: int = 1) -> DataFrame:
    """A row per removed span: ``id_col, start, end, kept_doc_id``."""
    return (mark(docs, id_col, text_col, min_words, lines, line_words).select(id_col, F.explode("removed").alias("r"))
            .select(id_col, "r.start", "r.end", "r.kept_doc_id"))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, lines: bool = False, line_words: int = 1) -> DataFrame:
    """``docs`` (all columns) with later occurrences cut out of the text."""
    others = [c for c in docs.columns if c != text_col]
    out = _mark(docs, id_col, text_col, min_words, others, line_words if lines else 0)
    named = {c: F.col(f"__{i}").alias(c) for i, c in enumerate(others)} | {text_col: F.col("__kept").alias(text_col)}
    return out.select(*(named[c] for c in docs.columns))
