"""Toxic spans by a linear-chain conditional random field.

Training takes a bounded sample of labelled documents (``TRAIN_DOCS`` of each
label, the smallest ids by hash). Token labels come from the document labels:
a greedy cover picks the features (a word or a word beginning) that explain
most toxic documents not yet explained and hardly occur in clean ones; a
token of a toxic document is labelled toxic if it has a picked feature. The
field then learns weights of hashed word, beginning and ending features and
the transitions by AdaGrad on the exact gradient (forward-backward).

Scoring runs over every whole text. Token sequences are cut into segments of
``SEGMENT`` tokens, and all segments of a block advance together, one
position at a time. The marginal of the toxic state at each token gives the
document score (their maximum) and the offending spans (runs of at least
0.5), with character offsets into the original text.

Defined results: null and empty texts, and texts without letters, score 0 and
have no spans; labels with a null id or label are ignored, repeated labels of
an id count as toxic if any is; repeated rows each give a row; without labels
of both kinds every score is 0; other columns never reach the model.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .textnum import LOWER, NOT_LETTER, U, Block, blocks, doc_slices, mix, span_keys

TRAIN_DOCS = 1500    # bound of the training sample, per label
SEGMENT = 64         # tokens per segment of the chain
BITS = 18            # hashed feature space
PREFIXES = (3, 4, 5, 6, 8)
COVER = 0.97         # least share of toxic documents among those with a picked feature
SUPPORT = 5          # least number of toxic documents that a picked feature explains anew (or one in 400)
OTHERS = 0.25        # share of the segments without a toxic token that are trained on
EPOCHS, RATE, L2 = 14, 0.5, 1e-6


def token_features(block: Block):
    """Tokens of a block (runs of letters) and their feature keys: the whole
    word, its first 3 to 8 bytes and its last 3; zero where it is shorter."""
    starts, ends, owner = block.runs(NOT_LETTER)
    prefix = block.prefix(LOWER)
    keys = [span_keys(prefix, starts, ends)]
    size = ends - starts
    for k in PREFIXES:
        ok = size >= k
        h = np.zeros(len(starts), np.uint64)
        h[ok] = mix(span_keys(prefix, starts[ok], starts[ok] + k) + U(k))
        keys.append(h)
    ok = size >= 4
    h = np.zeros(len(starts), np.uint64)
    h[ok] = mix(span_keys(prefix, ends[ok] - 3, ends[ok]) + U(99))
    keys.append(h)
    return starts, ends, owner, np.stack(keys) if len(starts) else np.zeros((len(PREFIXES) + 2, 0), np.uint64)


def slots(keys: np.ndarray) -> np.ndarray:
    """Weight slots of feature keys; slot 0 is the missing feature."""
    s = (keys >> U(64 - BITS)).astype(np.int32)
    s[keys == 0] = 0
    return s


def segments(owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First token and length of each segment."""
    at = doc_slices(owner, n)
    first = [np.arange(a, b, SEGMENT) for a, b in zip(at[:-1], at[1:]) if b > a]
    if not first:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.concatenate(first)
    ends = np.minimum(starts + SEGMENT, at[owner[starts] + 1])
    return starts, ends - starts


def _layout(emit: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Emissions as a (position, segment) matrix and the mask of real tokens."""
    pos = np.arange(int(size.max()))[:, None]
    mask = pos < size[None, :]
    idx = np.where(mask, starts[None, :] + pos, 0)
    return np.where(mask, emit[idx], 0.0), mask


def _chain(e: np.ndarray, mask: np.ndarray, trans: np.ndarray):
    """Forward and backward odds of state 1 against state 0 at each position.
    Padding is at the end of a segment and leaves its odds at one."""
    t = np.exp(trans)
    x = np.exp(np.clip(e, -30, 30))
    fwd, bwd = np.empty_like(x), np.ones_like(x)
    r = x[0]
    fwd[0] = r
    for k in range(1, len(x)):
        r = x[k] * (t[0, 1] + r * t[1, 1]) / (t[0, 0] + r * t[1, 0])
        fwd[k] = r = np.clip(r, 1e-30, 1e30)
    b = np.ones(x.shape[1])
    for k in range(len(x) - 2, -1, -1):
        y = x[k + 1] * b
        b = np.where(mask[k + 1], np.clip((t[1, 0] + t[1, 1] * y) / (t[0, 0] + t[0, 1] * y), 1e-30, 1e30), 1.0)
        bwd[k] = b
    return fwd, bwd


def marginals(emit: np.ndarray, owner: np.ndarray, n: int, trans: np.ndarray) -> np.ndarray:
    """Probability of the toxic state at each token."""
    p = np.zeros(len(emit))
    starts, size = segments(owner, n)
    if not len(starts):
        return p
    e, mask = _layout(emit, starts, size)
    fwd, bwd = _chain(e, mask, trans)
    odds = fwd * bwd
    idx = (starts[None, :] + np.arange(len(e))[:, None])[mask]
    p[idx] = (odds / (1 + odds))[mask]
    return p


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    trans: np.ndarray

    def emit(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(keys.shape[1], self.bias)
        for row in keys:
            out += self.weights[slots(row)]
        return out


def _pairs(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (feature key, text) of a block's word and beginning features, by key."""
    k = np.concatenate([row[row != 0] for row in keys[:-1]])
    d = np.concatenate([owner[row != 0] for row in keys[:-1]]).astype(np.int32)
    order = np.lexsort((d, k))
    k, d = k[order], d[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    return k[new], d[new]


def _read(texts: list[str]):
    """Features of the texts, a block at a time, with text numbers over all."""
    for b in blocks(pa.array(texts, pa.large_string())):
        _, _, owner, keys = token_features(b)
        yield keys, owner + b.first, b.first, len(b.bounds) - 1


def _cover(toxic: list[str], clean: list[str]) -> np.ndarray:
    """Greedy cover of the toxic texts by word and beginning features; returns
    the picked keys, sorted. Only features of enough toxic texts are counted in
    the clean ones, so memory follows the toxic texts."""
    found = [_pairs(keys, owner) for keys, owner, *_ in _read(toxic) if keys.shape[1]]
    if not found:
        return np.zeros(0, np.uint64)
    allk, docs = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(allk, kind="stable")
    allk, docs = allk[order], docs[order]
    at = np.flatnonzero(np.concatenate(([True], allk[1:] != allk[:-1])))
    ends = np.append(at[1:], len(allk))
    support = max(SUPPORT, len(toxic) // 400)
    many = ends - at >= support
    at, ends = at[many], ends[many]
    cand, pos = allk[at], ends - at
    neg = np.zeros(len(cand), np.int64)
    for keys, owner, *_ in _read(clean):
        if keys.shape[1] and len(cand):
            k, _ = _pairs(keys, owner)
            p = np.minimum(np.searchsorted(cand, k), len(cand) - 1)
            neg += np.bincount(p[cand[p] == k], minlength=len(cand))
    rate = max(1, len(clean)) / max(1, len(toxic))           # as if the labels were balanced
    good = np.flatnonzero(pos * rate >= COVER * (pos * rate + neg))
    left, picked = np.ones(len(toxic), bool), []
    for c in good[np.argsort(-pos[good], kind="stable")]:
        d = docs[at[c] : ends[c]]
        if left[d].sum() >= support:
            picked.append(cand[c])
            left[d] = False
    return np.sort(np.array(picked, np.uint64))


def fit(texts: list[str], labels: list[int]) -> Model:
    """Train on a bounded sample that fits into one task."""
    toxic = [t for t, y in zip(texts, labels) if y]
    clean = [t for t, y in zip(texts, labels) if not y]
    picked = _cover(toxic, clean)
    rng = np.random.default_rng(11)
    model = Model(np.zeros(1 << BITS), -2.0, np.zeros((2, 2)))

    def collect(part: list[str], wanted, marked: bool):
        """Slots, labels and lengths of the segments of which ``wanted`` says so."""
        out = []
        for keys, owner, first, n in _read(part):
            y = np.zeros(keys.shape[1], bool)
            for row in keys[:-1] if marked and len(picked) else ():
                y |= picked[np.minimum(np.searchsorted(picked, row), len(picked) - 1)] == row
            starts, size = segments(owner - first, n)
            if len(starts):
                take = np.flatnonzero(wanted(keys, owner - first, n, y, starts, size))
                starts, size = starts[take], size[take]
                token = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                out.append((np.stack([slots(k[token]) for k in keys]), y[token], size))
        return out

    def some(keys, owner, n, y, starts, size):
        cum = np.concatenate(([0], np.cumsum(y)))
        return (cum[starts + size] > cum[starts]) | (rng.random(len(starts)) < OTHERS)

    def mistaken(keys, owner, n, y, starts, size):
        wrong = np.concatenate(([0], np.cumsum(marginals(model.emit(keys), owner, n, model.trans) > 0.05)))
        return wrong[starts + size] > wrong[starts]

    # segments with a toxic token and a share of the others; then, twice, the
    # clean segments that the model takes for toxic
    parts = collect(toxic, some, True) + collect(clean, some, False)
    state = None
    for more in (EPOCHS, EPOCHS // 3, EPOCHS // 3):
        if state is not None:
            parts += collect(clean, mistaken, False)
        slot, y, size = (np.concatenate([x[i] for x in parts], axis=-1) for i in range(3))
        model, state = _descend(model, state, slot, y, size, more, rng)
    return Model(model.weights.astype(np.float32).astype(np.float64), model.bias, model.trans)


def _descend(model: Model, state, slot, y, size, epochs: int, rng) -> tuple[Model, tuple]:
    """AdaGrad on the exact gradient of the field's likelihood; ``state`` holds
    the sums of squared gradients between calls."""
    starts = np.cumsum(size) - size
    w, bias, trans = model.weights, model.bias, model.trans
    gw, gb, gt = state or (np.full(1 << BITS, 1e-2), 1e-2, np.full((2, 2), 1.0))
    for _ in range(epochs):
        for chunk in np.array_split(rng.permutation(len(starts)), max(1, len(starts) // 400)):
            s, z = starts[chunk], size[chunk]
            pos = np.arange(int(z.max()))[:, None]
            mask = pos < z[None, :]
            idx = np.where(mask, s[None, :] + pos, 0)
            e = np.where(mask, w[slot[:, idx]].sum(0) + bias, 0.0)
            fwd, bwd = _chain(e, mask, trans)
            odds = fwd * bwd
            p = odds / (1 + odds)
            grad = np.where(mask, p - y[idx], 0.0) / len(chunk)
            g = np.zeros(1 << BITS)
            flat = grad[mask]
            for row in slot:
                g += np.bincount(row[idx[mask]], flat, 1 << BITS)
            g[0] = 0
            g += L2 * w
            gw += g * g
            w -= RATE * g / np.sqrt(gw)
            gbias = flat.sum()
            gb += gbias * gbias
            bias -= RATE * gbias / np.sqrt(gb)
            # expected and observed transitions
            t = np.exp(trans)
            a1, a0 = fwd[:-1] / (1 + fwd[:-1]), 1 / (1 + fwd[:-1])
            nxt = np.exp(np.clip(e[1:], -30, 30)) * bwd[1:]
            joint = np.stack([[a0 * t[0, 0], a0 * t[0, 1] * nxt], [a1 * t[1, 0], a1 * t[1, 1] * nxt]])
            joint /= joint.sum((0, 1))
            both = mask[1:]
            y0, y1 = y[idx][:-1], y[idx][1:]
            gtr = np.array([[((joint[i, j] - ((y0 == i) & (y1 == j))) * both).sum() for j in (0, 1)] for i in (0, 1)]) / len(chunk)
            gt += gtr * gtr
            trans -= RATE * 0.2 * gtr / np.sqrt(gt)
    return Model(w, float(bias), trans), (gw, gb, gt)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model | None:
    """Fit on at most ``TRAIN_DOCS`` documents of each label. The ids are
    chosen from the labels alone, so the texts are found by one filtered scan."""
    marked = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
              .groupBy(id_col).agg(F.max(label_col).alias("__y")))
    order = F.xxhash64(F.col(id_col))
    chosen = None
    for y in (0, 1):
        part = marked.where(F.col("__y") == y).orderBy(order, id_col).limit(TRAIN_DOCS)
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most 2 * TRAIN_DOCS rows: small enough to broadcast whatever the corpus
    sample = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text")).join(F.broadcast(chosen), id_col)

    def run(batches):
        texts, ys = [], []
        for batch in batches:
            texts += [t or "" for t in batch.column(0).to_pylist()]
            ys += batch.column(1).to_pylist()
        if len(set(ys)) == 2:
            m = fit(texts, ys)
            yield pa.RecordBatch.from_arrays(
                [pa.array([m.weights.astype(np.float32).tobytes()], pa.binary()), pa.array([m.bias]),
                 pa.array([m.trans.ravel().tolist()], pa.list_(pa.float64()))], ["w", "bias", "trans"])

    # the scan and the join run in all its tasks; the sample, an id once, meets in one
    sample = sample.groupBy(id_col).agg(F.min("__text").alias("__text"), F.max("__y").alias("__y"))
    got = (sample.select("__text", "__y").repartition(1).sortWithinPartitions("__y", "__text")
           .mapInArrow(run, "w binary, bias double, trans array<double>").collect())
    if not got:
        return None
    r = got[0]
    return Model(np.frombuffer(bytes(r["w"]), np.float32).astype(np.float64), r["bias"], np.array(r["trans"]).reshape(2, 2))


def _spans(block: Block, starts, ends, owner, p, at, d) -> list[dict]:
    """Runs of toxic tokens of one text, as character offsets."""
    hit = np.flatnonzero(p[at[d] : at[d + 1]] >= 0.5) + at[d]
    if not len(hit):
        return []
    lo, hi = block.bounds[d], block.bounds[d + 1]
    chars = np.concatenate(([0], np.cumsum((block.data[lo:hi] & 0xC0) != 0x80)))
    out = []
    for run in np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1):
        out.append({"start": int(chars[starts[run[0]] - lo]), "end": int(chars[ends[run[-1]] - lo]), "p": float(p[run].max())})
    return out


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """Score each whole text: the ``keep`` columns (default ``id_col``), then
    ``score``, ``predicted`` and ``spans`` (start, end, p)."""
    keep = [id_col] if keep is None else keep
    box = docs.sparkSession.sparkContext.broadcast(model)     # about 2 MB by BITS, whatever the corpus
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches):
        m = box.value
        for batch in batches:
            col = batch.column(0)
            best, spans = np.zeros(len(col)), [[] for _ in range(len(col))]
            for b in blocks(col) if m is not None else ():
                starts, ends, owner, keys = token_features(b)
                n = len(b.bounds) - 1
                p = marginals(m.emit(keys), owner, n, m.trans)
                at = doc_slices(owner, n)
                np.maximum.at(best, owner + b.first, p)
                for d in np.unique(owner[p >= 0.5]):
                    spans[b.first + d] = _spans(b, starts, ends, owner, p, at, d)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(best), pa.array((best >= 0.5).astype(np.int32)), pa.array(spans, kind)],
                [*keep, "score", "predicted", "spans"])

    src = docs.select(F.col(text_col).cast("string").alias("__text"), *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[1:])
    return src.mapInArrow(run, f"{schema}, score double, predicted int, spans array<struct<start:bigint,end:bigint,p:double>>")
