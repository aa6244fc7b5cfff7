"""Periodic runs of words by seed-and-extend diagonals.

A run is a stretch of consecutive words with smallest period q, of at least
``least`` words and two periods, that no neighbouring word extends. Word i and
word i + q of it are the same: an equal stretch on diagonal q, at least
max(least - q, q) words long. Any k-gram inside that guaranteed overlap, which
occurs again q words later, is a seed. Lags are worked on by doubling ranges:

* lags below ``_first_lag(least)`` by all k-grams of the overlap that every
  such lag guarantees (half of ``least``);
* lags of lo to 2 lo - 1 by k-grams of 3/4 lo + 1 words that start at every
  lo/4-th word, one of which lies in any overlap of lo words. So a range of lags
  has at most four times as many pairs of occurrences as the text has words,
  however often a word repeats.

Pairs of occurrences in the same text are read off the sorted k-grams. Ordered
by lag and start, a pair inside the stretch its predecessor covers adds
nothing: only the first and the last of each such chain are extended, by
bisection on prefix polynomials. Equal words have equal numbers (a dictionary,
no hash), and each run is compared word by word in the end; a text in which a
polynomial misled is done again lag by lag.

Texts are worked on in blocks of about ``textnum.BLOCK`` bytes, so memory
follows the longest text only. No shuffle.

Defined results: a null text has no words, no runs and an empty collapsed
text; every row gives a row (repeated ids too, null ids stay null); an empty
table gives none; other columns are dropped, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .textnum import BLOCK, U, _powers, mix, text_bytes

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _first_lag(least: int) -> int:
    lo = 4
    while 3 * lo // 4 + 1 < (least + 1) // 2:
        lo *= 2
    return lo


class Words:
    """Word numbers of several texts, back to back, with the bounds of each."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray):
        self.ids, self.bounds = ids, bounds
        self.power, self.inverse = _powers(len(ids))
        self.prefix = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum(mix(ids.astype(np.uint64) + U(1)) * self.power[: len(ids)], out=self.prefix[1:])
        sizes = np.diff(bounds)
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.lo, self.hi = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)

    def grams(self, at: np.ndarray, size: int) -> np.ndarray:
        return (self.prefix[at + size] - self.prefix[at]) * self.inverse[at]

    def same(self, a: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` words from ``a`` on occur again ``lag`` words later."""
        return (self.prefix[a + size] - self.prefix[a]) * self.power[lag] == self.prefix[a + lag + size] - self.prefix[a + lag]

    def extend(self, at: np.ndarray, lag: np.ndarray, room: np.ndarray, back: bool) -> np.ndarray:
        """Most words, up to ``room``, that are the same on the diagonal after (or before) ``at``."""
        have, step = np.zeros(len(at), np.int64), 1
        while step <= (room.max() if len(room) else 0):
            step *= 2
        while step:
            more = np.flatnonzero(have + step <= room)
            a = at[more] - have[more] - step if back else at[more] + have[more]
            have[more[self.same(a, lag[more], np.full(len(more), step))]] += step
            step //= 2
        return have


def _chains(w: Words, alive: np.ndarray, lo: int, end: int, gram: int, step: int):
    """Seeds of the lags ``lo .. end - 1``, joined to chains: first word, end
    (exclusive) and lag of each equal stretch; and the words whose gram occurs
    again in their text."""
    none = np.zeros(0, np.int64)
    alive = alive[w.hi[alive] - alive >= gram]
    if len(alive) < 2:
        return none, none, none, none
    h = w.grams(alive, gram)
    order = np.argsort(h, kind="stable")
    h, pos = h[order], alive[order]
    link = (h[1:] == h[:-1]) & (w.doc[pos[1:]] == w.doc[pos[:-1]])
    keep = np.zeros(len(pos), bool)
    keep[1:] |= link
    keep[:-1] |= link
    pos, h = pos[keep], h[keep]
    if not len(pos):
        return none, none, none, none
    group = np.cumsum(np.concatenate(([0], (h[1:] != h[:-1]) | (w.doc[pos[1:]] != w.doc[pos[:-1]]))))
    line = group * (len(w.ids) + 1) + pos                     # ascending: by group, then position
    seed = np.flatnonzero((pos - w.lo[pos]) % step == 0)
    p = pos[seed]
    limit = w.hi[p]
    base = group[seed] * (len(w.ids) + 1)
    a = np.searchsorted(line, base + np.minimum(p + lo, limit))
    b = np.searchsorted(line, base + np.minimum(p + end, limit))
    n = b - a
    p = np.repeat(p, n)
    other = pos[np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    lag = other - p
    by = np.lexsort((p, lag))
    p, lag = p[by], lag[by]
    if not len(p):
        return none, none, none, np.sort(pos)
    new = np.concatenate(([True], (lag[1:] != lag[:-1]) | (p[1:] - p[:-1] > step) | (w.doc[p[1:]] != w.doc[p[:-1]])))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    return p[first], p[last] + gram, lag[first], np.sort(pos)


def find(ids: np.ndarray, bounds: np.ndarray, least: int = 12) -> np.ndarray:
    """Rows (text, start, length, period) of all runs of several texts, by
    text, start and period."""
    w = Words(ids, bounds)
    longest = int(np.diff(bounds).max()) if len(bounds) > 1 else 0
    sizes = w.hi - w.lo
    alive = np.flatnonzero(sizes >= least)
    lo, end = 1, _first_lag(least)
    gram, step = (least + 1) // 2, 1
    found = []
    while len(alive) and 2 * lo <= longest:
        s, e, lag, alive = _chains(w, alive, lo, end, gram, step)
        if len(s):
            back = w.extend(s, lag, np.minimum(s - w.lo[s], step), True)
            more = w.extend(e, lag, np.minimum(w.hi[s] - lag - e, step), False)
            s, e = s - back, e + more + lag
            ok = e - s >= np.maximum(least, 2 * lag)
            found.append(np.stack((s[ok], e[ok], lag[ok]), 1))
        lo, end = end, 2 * end
        step, gram = lo // 4, 3 * lo // 4 + 1
        alive = alive[sizes[alive] >= 2 * lo]
    if not found:
        return np.zeros((0, 4), np.int64)
    r = np.concatenate(found)
    r = r[np.lexsort((r[:, 2], r[:, 1], r[:, 0]))]            # the smallest period of each stretch
    r = r[np.concatenate(([True], (r[1:, :2] != r[:-1, :2]).any(1)))] if len(r) else r
    doc = w.doc[r[:, 0]]
    out = np.stack((doc, r[:, 0] - bounds[doc], r[:, 1] - r[:, 0], r[:, 2]), 1)
    wrong = {int(d) for d, (s, e, q) in zip(doc, r.tolist()) if not np.array_equal(ids[s : e - q], ids[s + q : e])}
    if wrong:
        again = [_lag_by_lag(ids[bounds[d] : bounds[d + 1]], d, least) for d in sorted(wrong)]
        out = np.concatenate([out[~np.isin(doc, list(wrong))], *again])
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _lag_by_lag(ids: np.ndarray, doc: int, least: int) -> np.ndarray:
    """The runs of one text by comparing it with itself at every lag."""
    best: dict[tuple[int, int], int] = {}
    for q in range(1, len(ids) // 2 + 1):
        edge = np.diff(np.concatenate(([0], (ids[:-q] == ids[q:]).astype(np.int8), [0])))
        for s, e in zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) + q).tolist()):
            if e - s >= max(least, 2 * q):
                best.setdefault((s, e), q)
    return np.array([(doc, s, e - s, q) for (s, e), q in best.items()], np.int64).reshape(-1, 4)


def dropped(runs: np.ndarray, n: int) -> np.ndarray:
    """Words of a text that a run (start, length, period) holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 12) -> DataFrame:
    """Per row: the id, ``n_words``, ``runs`` (by start, then period; start
    counts words from 0) and ``collapsed`` (the words outside repeats, joined
    by one space)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField(id_col, src.schema["id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())])

    def run(batches):
        for batch in batches:
            raw, at = text_bytes(batch.column(1))
            i, n = 0, batch.num_rows
            while i < n:
                j = min(n, max(i + 1, int(np.searchsorted(at, at[i] + BLOCK, side="right")) - 1))
                yield block(batch.column(0).slice(i, j - i), raw, at[i : j + 1])
                i = j

    def block(ids, raw, at):
        number: dict = defaultdict()
        number.default_factory = number.__len__
        texts = [raw[a:b].tobytes().split() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        sizes = np.array([len(t) for t in texts], np.int64)
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        nums = np.fromiter((x for t in texts for x in map(number.__getitem__, t)), np.int64, int(bounds[-1]))
        found = find(nums, bounds, least)
        cut = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
        kept = []
        for k, words in enumerate(texts):
            mine = found[cut[k] : cut[k + 1], 1:]
            if len(mine):
                out = dropped(mine, len(words))
                words = [x for x, o in zip(words, out.tolist()) if not o]
            kept.append(b" ".join(words).decode())
        runs = pa.StructArray.from_arrays([pa.array(found[:, c].copy()) for c in (1, 2, 3)], ["start", "length", "period"])
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), runs), pa.array(kept, pa.string())],
            [id_col, "n_words", "runs", "collapsed"])

    return src.mapInArrow(run, schema)


def longest(runs="runs"):
    """The run of greatest length; ties: smallest start, then period. Null without runs."""
    r = F.array_max(F.transform(runs, lambda x: F.struct(x["length"].alias("length"), (-x["start"]).alias("start"), (-x["period"]).alias("period"))))
    return F.when(r.isNotNull(), F.struct((-r["start"]).alias("start"), r["length"].alias("length"), (-r["period"]).alias("period")))
