"""Brown class-based bigram language model.

Exchange clustering puts all training words that occur ``LEAST`` times or more
into ``CLASSES`` classes (moves raise the average mutual information of
adjacent classes); rarer words fall into shape classes by their last byte
and script, and each text's end is a class of its own. The ``WORDS`` most
frequent are clustered first, on the driver. The others then get the class
that fits their neighbours' classes best, and all words are moved again in
``PARTS`` blocks: each block's counts of neighbouring classes are grouped per
word, and its words move at once against the broadcast class matrix; a block
that lowers the likelihood of the training texts is taken back. The probability of a
token is that of its class after the previous token's class, interpolated
with the class's own, times that of the word in its class, with one added to
every count and, in the shape classes, one unseen word.

Word counts come from all training texts by a packed exchange. A text's
class sequence is scored where the text is read; the counts of its rare words
are fetched by a second exchange, reduced per text where they meet, and
added. Broadcast are ``LOCAL`` words and the class matrix, which have fixed
bounds, and the classes of the clustered words (about 20 bytes each).

Defined results: a null text counts as empty and has its end as only token; a
null id counts as the empty string for the fold (a training row); repeated
rows and ids each give a row (and count each); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import packed, scratch
from .textnum import LOWER, U, WHITE, blocks, doc_slices, span_keys

WORDS = 1_000        # words that are clustered first
LEAST = 10           # occurrences of a clustered word
PARTS = 2            # blocks of a sweep over all words
CLASSES = 40
LOCAL = 65_536       # frequent words whose counts every task knows
SWEEPS = 4
SHAPES = 4           # of a word: ends in a letter or not, ASCII or not
BETA = 20.0          # weight of a class's own probability in a transition
END = WORDS + SHAPES  # state of the end token


def tokens(block):
    """Word keys (shape in the lowest two bits), owner, for one block."""
    starts, ends, owner = block.runs(WHITE)
    keys = span_keys(block.prefix(LOWER), starts, ends)
    if len(keys):
        last = block.data[ends - 1]
        letter = (last >= 128) | ((last | 32) >= 97) & ((last | 32) <= 122)
        high = np.concatenate(([0], np.cumsum(block.data >= 128)))
        ascii_ = high[ends] == high[starts]
        keys = (keys & ~U(3)) | (letter * U(2) + ascii_ * U(1)).astype(np.uint64)
    return keys, owner


# -- counts -----------------------------------------------------------------
def count_words(train: DataFrame, text_col: str, bits: int) -> DataFrame:
    """Per bucket: sorted ``keys`` and their ``counts`` in the training texts."""
    def emit(batches):
        held, size = [], 0
        for batch in batches:
            for b in blocks(batch.column(0)):
                held.append(np.unique(tokens(b)[0], return_counts=True))
                size += len(held[-1][0])
                if size >= packed.FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    def flush(held):
        k, c = _merge(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
        cols = list(zip(*packed.pack(bits, k, c.astype(np.int64)))) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())],
                                          ["bucket", "keys", "counts"])

    def gather(key, table):
        k, c = _merge(packed.unpack(table.column("keys"), np.uint64), packed.unpack(table.column("counts"), np.int64))
        top = np.argsort(-c, kind="stable")[:LOCAL]
        shape = (k & U(3)).astype(np.int64)
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "keys": pa.array([k.tobytes()], pa.binary()),
                         "counts": pa.array([c.tobytes()], pa.binary()), "top": pa.array([np.stack((k[top].view(np.int64), c[top]), 1).tobytes()], pa.binary()),
                         "mass": [np.bincount(shape, c, SHAPES).astype(np.int64).tolist()], "types": [np.bincount(shape, minlength=SHAPES).tolist()]})

    out = (train.select(F.col(text_col).cast("string").alias("t")).mapInArrow(emit, "bucket long, keys binary, counts binary")
           .groupBy("bucket").applyInArrow(gather, "bucket long, keys binary, counts binary, top binary, mass array<long>, types array<long>"))
    return scratch.table(out, "counts")


def _merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[start], np.add.reduceat(counts, start)


def frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most ``LOCAL`` frequent words, most frequent first (1 MB)."""
    def run(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0].copy()), pa.array(x[:, 1].copy())], ["key", "c"])

    return packed.most_frequent(counts.select("top").mapInArrow(run, "key long, c long"), LOCAL)


def above(counts: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """All words that occur ``least`` times or more, sorted, and their counts."""
    def run(batches):
        for batch in batches:
            k, c = packed.unpack(batch.column(0), np.uint64), packed.unpack(batch.column(1), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(k[c >= least].view(np.int64)), pa.array(c[c >= least])], ["key", "c"])

    got = counts.select("keys", "counts").mapInArrow(run, "key long, c long").toArrow()
    keys, c = got.column("key").to_numpy().view(np.uint64), got.column("c").to_numpy()
    order = np.argsort(keys)
    return keys[order], c[order]


class Index:
    """Positions of hashed keys in a sorted array, by a table of their top bits."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.bits = keys, max(1, len(keys).bit_length())
        top = (keys >> U(64 - self.bits)).astype(np.int64)
        self.start = np.searchsorted(top, np.arange((1 << self.bits) + 1)).astype(np.int32 if len(keys) < 1 << 31 else np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """-1 where a key is not there."""
        out = np.full(len(keys), -1, np.int64)
        top = (keys >> U(64 - self.bits)).astype(np.int64)
        at, end = self.start[top], self.start[top + 1]
        left = np.flatnonzero(at < end)
        at, end, want = at[left], end[left], keys[left]
        while len(left):
            hit = self.keys[at] == want
            out[left[hit]] = at[hit]
            more = ~hit & (at + 1 < end)
            left, at, end, want = left[more], at[more] + 1, end[more], want[more]
        return out


@dataclass
class States:
    """The words clustered first, sorted, with the number of each, and the
    classes of the other clustered words, which stand for states after the
    end's."""

    keys: np.ndarray
    number: np.ndarray
    others: Index | None = None
    other_cls: np.ndarray | None = None

    def of(self, keys: np.ndarray) -> np.ndarray:
        s = WORDS + (keys & U(3)).astype(np.int64)
        if self.others is not None and len(keys):
            p = self.others.find(keys)
            s[p >= 0] = self.other_cls[p[p >= 0]].astype(np.int64) + (END + 1)
        if len(self.keys) and len(keys):
            p = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[p] == keys
            s[hit] = self.number[p[hit]]
        return s


def sequences(block, states: States):
    """State of each token, ends included, with the text of each, and the
    previous token's state (the end's before the first)."""
    keys, owner = tokens(block)
    n = len(block.bounds) - 1
    at = doc_slices(owner, n)
    size = np.diff(at) + 1
    stop = np.cumsum(size) - 1
    s = np.full(int(size.sum()), END, np.int64)
    inner = np.ones(len(s), bool)
    inner[stop] = False
    s[inner] = states.of(keys)
    prev = np.empty_like(s)
    prev[1:] = s[:-1]
    prev[:1] = END
    prev[stop[:-1] + 1] = END
    return keys, owner, s, prev, np.repeat(np.arange(n), size)


def count_pairs(train: DataFrame, text_col: str, states: States) -> np.ndarray:
    """Adjacent state counts in the training texts: a matrix of fixed size."""
    box = train.sparkSession.sparkContext.broadcast(states)
    m = END + 1

    def emit(batches):
        total = np.zeros(m * m, np.int64)
        for batch in batches:
            for b in blocks(batch.column(0)):
                _, _, s, prev, _ = sequences(b, box.value)
                total += np.bincount(prev * m + s, minlength=m * m)
        rows = np.flatnonzero(total.reshape(m, m).any(1))
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array([total[r * m : (r + 1) * m].tobytes() for r in rows], pa.binary())], ["prev", "row"])

    def add(key, table):
        rows = np.frombuffer(b"".join(table.column("row").to_pylist()), np.int64).reshape(-1, m)
        return pa.table({"prev": pa.array([key[0].as_py()], pa.int64()), "row": pa.array([rows.sum(0).tobytes()], pa.binary())})

    got = (train.select(F.col(text_col).cast("string").alias("t")).mapInArrow(emit, "prev long, row binary")
           .groupBy("prev").applyInArrow(add, "prev long, row binary").toArrow())
    out = np.zeros((m, m), np.int64)
    for p, r in zip(got.column("prev").to_pylist(), got.column("row").to_pylist()):
        out[p] = np.frombuffer(r, np.int64)
    return out


# -- classes ----------------------------------------------------------------
def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def cluster(pairs: np.ndarray, n_words: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Exchange clustering; returns the class of each state. Shape states and
    the end keep classes of their own, after the ``classes`` of the words."""
    m = END + 1
    cls = np.zeros(m, np.int64)
    cls[:n_words] = np.arange(n_words) % classes          # by frequency, in turn
    cls[WORDS:] = classes + np.arange(SHAPES + 1)
    c = classes + SHAPES + 1
    one = np.zeros((m, c))
    one[np.arange(m), cls] = 1
    one[n_words:WORDS] = 0
    n = pairs.astype(np.float64)
    big = one.T @ n @ one
    for _ in range(sweeps):
        moved = 0
        for w in range(n_words):
            out, into, self_ = n[w] @ one, n[:, w] @ one, n[w, w]
            old = cls[w]
            out[old] -= self_
            into[old] -= self_
            big[old] -= out
            big[:, old] -= into
            big[old, old] -= self_
            left, right = big.sum(1) + into, big.sum(0) + out
            # likelihood gained by adding the word to each class
            k = np.arange(classes)
            rows = _xlogx(big[k] + out) - _xlogx(big[k])
            cols = _xlogx(big[:, k].T + into) - _xlogx(big[:, k].T)
            gain = rows.sum(1) + cols.sum(1) - rows[k, k] - cols[k, k]
            gain += _xlogx(big[k, k] + out[k] + into[k] + self_) - _xlogx(big[k, k])
            gain -= _xlogx(left[k] + out.sum() + self_) - _xlogx(left[k])
            gain -= _xlogx(right[k] + into.sum() + self_) - _xlogx(right[k])
            new = int(np.argmax(gain)) if gain.max() > gain[old] + 1e-9 else old
            moved += new != old
            one[w, old], one[w, new], cls[w] = 0, 1, new
            big[new] += out
            big[:, new] += into
            big[new, new] += self_
        if not moved:
            break
    return cls


def likelihood(big: np.ndarray) -> float:
    """Log likelihood of the classes, up to what the words' counts give."""
    return float(_xlogx(big).sum() - _xlogx(big.sum(0)).sum() - _xlogx(big.sum(1)).sum())


def best_classes(big: np.ndarray, out: np.ndarray, into: np.ndarray, self_: np.ndarray, old: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """Class (of the first ``classes``) that each word fits best, the others
    staying where they are. ``out`` and ``into``: counts of the classes after
    and before each word; ``self_``: of the word after itself. Only classes
    that a word meets are worked on."""
    n, r, k = len(old), np.arange(len(old)), np.arange(classes)
    out, into = out.astype(np.float64), into.astype(np.float64)
    out[r, old] -= self_
    into[r, old] -= self_
    was = np.flatnonzero(old < classes)
    gain = np.zeros((n, classes))
    for x, y, b in ((out, into, big), (into, out, big.T)):
        w, c = np.nonzero(x > 0)
        times = x[w, c]
        rest = b[:classes, c].T.copy()                  # the class matrix without the word
        at = np.flatnonzero(old[w] < classes)
        rest[at, old[w[at]]] -= times[at]
        same = np.flatnonzero(old[w] == c)
        rest[same] -= y[w[same], :classes]
        mine = same[old[w[same]] < classes]
        rest[mine, old[w[mine]]] -= self_[w[mine]]
        more = _xlogx(rest + times[:, None]) - _xlogx(rest)
        inner = np.flatnonzero(c < classes)
        more[inner, c[inner]] = 0                        # the diagonal follows
        if len(w):
            start = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
            gain[w[start]] += np.add.reduceat(more, start, axis=0)
    diagonal = np.repeat(big[k, k][None], n, 0)
    diagonal[was, old[was]] -= out[was, old[was]] + into[was, old[was]] + self_[was]
    gain += _xlogx(diagonal + out[:, :classes] + into[:, :classes] + self_[:, None]) - _xlogx(diagonal)
    for x, y, total in ((out, into, big.sum(1)), (into, out, big.sum(0))):
        size = x.sum(1) + self_
        rest = total[None, :classes] + np.zeros((n, 1))
        rest[was, old[was]] -= size[was]
        gain -= _xlogx(rest + size[:, None]) - _xlogx(rest)
    new = gain.argmax(1)
    stay = was[gain[was, new[was]] <= gain[was, old[was]] + 1e-9]
    new[stay] = old[stay]
    return new


def _neighbours(block, index: Index, cls: np.ndarray):
    """Clustered word (or -1) and class of each token, ends included, and of the one before."""
    keys, owner = tokens(block)
    n = len(block.bounds) - 1
    stop = np.cumsum(np.diff(doc_slices(owner, n)) + 1) - 1
    inner = np.ones(len(keys) + n, bool)
    inner[stop] = False
    word, c = np.full(len(inner), -1, np.int64), np.full(len(inner), CLASSES + SHAPES, np.int64)
    p = index.find(keys)
    word[inner], c[inner] = p, np.where(p >= 0, cls[np.maximum(p, 0)], CLASSES + (keys & U(3)).astype(np.int64))
    return word, c, np.concatenate((word[-1:], word[:-1])), np.concatenate((c[-1:], c[:-1]))


def count_classes(train: DataFrame, text_col: str, index, cls) -> np.ndarray:
    """Adjacent class counts in the training texts (``index`` and ``cls`` are broadcast)."""
    c = CLASSES + SHAPES + 1

    def emit(batches):
        total = np.zeros(c * c, np.int64)
        for batch in batches:
            for b in blocks(batch.column(0)):
                _, now, _, before = _neighbours(b, index.value, cls.value)
                total += np.bincount(before * c + now, minlength=c * c)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    got = (train.select(F.col(text_col).cast("string").alias("t")).mapInArrow(emit, "at long, n long")
           .groupBy("at").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(c * c)
    out[got.column("at").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(c, c)


def move(train: DataFrame, text_col: str, index, cls, big: np.ndarray, chosen, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Words among the ``chosen`` (a function of their positions) that fit
    another class better, and that class."""
    box = train.sparkSession.sparkContext.broadcast(big)
    c = CLASSES + SHAPES + 1
    shift = max(0, len(cls.value).bit_length() - bits)

    def emit(batches):
        held, size = [], 0
        for batch in batches:
            for b in blocks(batch.column(0)):
                word, now, word_before, before = _neighbours(b, index.value, cls.value)
                w, x = (word >= 0) & chosen(word), (word_before >= 0) & chosen(word_before)
                code = np.concatenate((word[w] << 7 | before[w], word_before[x] << 7 | (c + now[x]), word[w & (word == word_before)] << 7 | 2 * c))
                held.append(np.unique(code, return_counts=True))
                size += len(held[-1][0])
                if size >= packed.FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    def flush(held):
        code, n = _merge(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
        bucket = code >> (7 + shift)
        start = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(code) else np.zeros(0, np.int64)
        end = np.append(start[1:], len(code))
        # the entries of a bucket by their position in it: 25 bits and 7 of the class fit into 32
        code = (code & ((1 << (7 + shift)) - 1)).astype(np.uint32 if shift <= 25 else np.uint64)
        n = n.astype(np.uint32)
        return pa.RecordBatch.from_arrays([
            pa.array(bucket[start]), pa.array([code[i:j].tobytes() for i, j in zip(start, end)], pa.binary()),
            pa.array([n[i:j].tobytes() for i, j in zip(start, end)], pa.binary())], ["bucket", "codes", "counts"])

    def gather(key, table):
        code = packed.unpack(table.column("codes"), np.uint32 if shift <= 25 else np.uint64).astype(np.int64)
        code, n = _merge(code, packed.unpack(table.column("counts"), np.uint32).astype(np.int64))
        first = key[0].as_py() << shift
        words, at = np.unique(code >> 7, return_inverse=True)
        got, fits = [], []
        for lo in range(0, len(words), 512):
            hi = min(lo + 512, len(words))
            i, j = np.searchsorted(at, (lo, hi))
            x = np.bincount((at[i:j] - lo) << 7 | code[i:j] & 127, n[i:j], (hi - lo) << 7).reshape(-1, 128)
            old = cls.value[first + words[lo:hi]].astype(np.int64)
            new = best_classes(box.value, x[:, c : 2 * c], x[:, :c], x[:, 2 * c], old)
            got.append(first + words[lo:hi][new != old])
            fits.append(new[new != old])
        return pa.table({"word": pa.array(np.concatenate(got), pa.int64()), "cls": pa.array(np.concatenate(fits), pa.int8())})

    out = (train.select(F.col(text_col).cast("string").alias("t")).mapInArrow(emit, "bucket long, codes binary, counts binary")
           .groupBy("bucket").applyInArrow(gather, "word long, cls byte").toArrow())
    return out.column("word").to_numpy(), out.column("cls").to_numpy()


def spread(train: DataFrame, text_col: str, keys: np.ndarray, cls: np.ndarray, big: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all words ``keys`` (sorted), of which those that start in a
    shape class get one and then all are moved, and the class matrix."""
    sc = train.sparkSession.sparkContext
    index, cls = sc.broadcast(Index(keys)), cls.astype(np.uint8)
    new = cls >= CLASSES                    # bounded like the classes: a byte per word
    box = sc.broadcast(new)
    steps = [lambda w: box.value[w]] + [lambda w, part=part: w % PARTS == part for part in range(PARTS)]
    for chosen in steps:
        was = sc.broadcast(cls)
        at, to = move(train, text_col, index, was, big, chosen, bits)
        if not len(at):
            continue
        moved = cls.copy()
        moved[at] = to
        then = sc.broadcast(moved)
        after = count_classes(train, text_col, index, then)
        if (cls[new] >= CLASSES).any() or likelihood(after) > likelihood(big):
            cls, big = moved, after
    return cls.astype(np.int64), big


@dataclass
class Model:
    states: States
    cls: np.ndarray            # class of each state
    step: np.ndarray           # log10 of each class transition
    denominator: np.ndarray    # log10 of the emission denominator of each class
    local_keys: np.ndarray
    local_gain: np.ndarray     # log10(count + 1)
    n: int                     # training tokens
    v: int                     # distinct tokens
    ends: int


def fit(train: DataFrame, text_col: str, bits: int) -> tuple[Model, DataFrame]:
    counts = count_words(train, text_col, bits)
    ends = train.count()
    keys, c = frequent(counts)
    total = counts.select(*(F.sum(F.col("mass")[i]).alias(f"m{i}") for i in range(SHAPES)), *(F.sum(F.col("types")[i]).alias(f"t{i}") for i in range(SHAPES))).first()
    mass, types = [int(total[i] or 0) for i in range(SHAPES)], [int(total[SHAPES + i] or 0) for i in range(SHAPES)]
    head, head_c = keys[:WORDS], c[:WORDS]
    order = np.argsort(head)
    states = States(head[order], order.astype(np.int64))
    pairs = count_pairs(train, text_col, states)
    cls = cluster(pairs, len(head))
    n_cls = CLASSES + SHAPES + 1
    one = np.zeros((END + 1, n_cls))
    one[np.arange(END + 1), cls] = 1
    one[len(head) : WORDS] = 0
    big = one.T @ pairs @ one
    words, words_c = above(counts, LEAST)
    other = ~np.isin(words, head)
    if other.any():
        every, every_c = np.concatenate((head, words[other])), np.concatenate((head_c, words_c[other]))
        shape = CLASSES + (words[other] & U(3)).astype(np.int64)
        if not len(head):                   # no class to start from: deal the words out
            shape = np.arange(len(shape)) % CLASSES
        by_key = np.argsort(every)
        found = np.zeros(len(every), np.int64)
        found[by_key], big = spread(train, text_col, every[by_key], np.concatenate((cls[: len(head)], shape))[by_key], big, bits)
        cls[: len(head)] = found[: len(head)]
        states = States(states.keys, states.number, Index(words[other]), found[len(head) :].astype(np.uint8))
        cls = np.concatenate((cls, np.arange(CLASSES)))
    else:
        every, every_c, found = head, head_c, cls[: len(head)]
    own = (big.sum(0) + 1) / (big.sum() + n_cls)
    step = np.log10((big + BETA * own[None, :]) / (big.sum(1, keepdims=True) + BETA))
    den = np.zeros(n_cls)
    den[:CLASSES] = np.bincount(found, every_c + 1, CLASSES)[:CLASSES]
    for s in range(SHAPES):
        mine = (every & U(3)) == U(s)
        den[CLASSES + s] = mass[s] - every_c[mine].sum() + types[s] - mine.sum() + 1
    den[-1] = ends + 1
    lo = np.argsort(keys)
    model = Model(states, cls, step, np.log10(np.maximum(den, 1)), keys[lo], np.log10(c[lo] + 1.0), sum(mass) + ends, sum(types) + (ends > 0), ends)
    return model, counts


# -- scores -----------------------------------------------------------------
def score(docs: DataFrame, train_when, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows where ``train_when`` holds and score all rows:
    ``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    bits = packed.bucket_bits(docs)
    src = docs.select(F.col(id_col).alias("id"), (~F.coalesce(train_when, F.lit(False))).alias("out"), F.col(text_col).cast("string").alias("t"))
    model, counts = fit(src.where(~F.col("out")), "t", bits)
    box = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def read(batches):
        """A row per run of texts with what is known at once, and rows of rare
        words by bucket: key, text within the run, times."""
        m = box.value
        for batch in batches:
            for b in blocks(batch.column(2)):
                n = len(b.bounds) - 1
                run = uuid.uuid4().hex
                keys, owner, s, prev, who = sequences(b, m.states)
                c = m.cls[s]
                score_ = np.bincount(who, m.step[m.cls[prev], c] - m.denominator[c], n)
                gain, known = np.full(n, np.log10(m.ends + 1.0)), np.full(n, int(m.ends > 0))
                rare = np.ones(len(keys), bool)
                if len(keys) and len(m.local_keys):
                    p = np.minimum(np.searchsorted(m.local_keys, keys), len(m.local_keys) - 1)
                    hit = m.local_keys[p] == keys
                    gain += np.bincount(owner[hit], m.local_gain[p[hit]], n)
                    known += np.bincount(owner[hit], minlength=n)
                    rare = ~hit
                at = slice(b.first, b.first + n)
                head = [run, None, None, None, None, None]
                ids, out = batch.column(0).slice(b.first, n), batch.column(1).slice(b.first, n)
                k, o = keys[rare], owner[rare]
                order = np.lexsort((o, k))
                k, o = k[order], o[order]
                new = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])))) if len(k) else np.zeros(0, np.int64)
                times = np.diff(np.append(new, len(k))).astype(np.uint32)
                rows = list(packed.pack(bits, k[new], o[new].astype(np.uint32), times))
                z = 1 + len(rows)
                cols = list(zip(*rows)) or [[], [], [], []]
                ids_col = pa.array([ids.to_pylist()] + [None] * len(rows), pa.list_(batch.schema.field(0).type))
                yield pa.RecordBatch.from_arrays([
                    pa.array([run] * z), ids_col, pa.array([out.to_pylist()] + [None] * len(rows), pa.list_(pa.bool_())),
                    pa.array([(np.diff(doc_slices(owner, n)) + 1).tolist()] + [None] * len(rows), pa.list_(pa.int64())),
                    pa.array([None, *cols[0]], pa.int64()),
                    pa.array([gain.tobytes(), *cols[1]], pa.binary()),
                    pa.array([known.astype(np.int64).tobytes(), *cols[2]], pa.binary()),
                    pa.array([score_.tobytes(), *cols[3]], pa.binary())], ["run", "ids", "out", "size", "bucket", "x", "y", "z"])
                del head, at

    table = scratch.table(src.select("id", "out", "t").mapInArrow(
        read, f"run string, ids array<{kind}>, out array<boolean>, size array<long>, bucket long, x binary, y binary, z binary"), "read")

    def look_up(key, t):
        """Per run: log10(count + 1) and known tokens, summed per text."""
        runs = t.column("run").to_pylist()
        base = runs.index(None) if None in runs else -1
        xs, ys, zs = (t.column(c).to_pylist() for c in "xyz")
        keys = np.frombuffer(xs[base], np.uint64) if base >= 0 else np.zeros(0, np.uint64)
        cnt = np.frombuffer(ys[base], np.int64) if base >= 0 else np.zeros(0, np.int64)
        out = {"run": [], "x": [], "y": [], "z": []}
        for i, r in enumerate(runs):
            if r is None:
                continue
            k, o, f = np.frombuffer(xs[i], np.uint64), np.frombuffer(ys[i], np.uint32), np.frombuffer(zs[i], np.uint32)
            c = np.zeros(len(k), np.int64)
            if len(keys):
                p = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
                c = np.where(keys[p] == k, cnt[p], 0)
            who, inv = np.unique(o, return_inverse=True)
            out["run"].append(r)
            out["x"].append(who.tobytes())
            out["y"].append(np.bincount(inv, f * np.log10(c + 1.0), len(who)).tobytes())
            out["z"].append(np.bincount(inv, f * (c > 0), len(who)).astype(np.int64).tobytes())
        return pa.table({"run": pa.array(out["run"], pa.string()), "bucket": pa.array([key[0].as_py()] * len(out["run"]), pa.int64()),
                         **{c: pa.array(out[c], pa.binary()) for c in "xyz"}})

    rare = table.where("bucket is not null").select("bucket", "run", "x", "y", "z")
    words = counts.select("bucket", F.lit(None).cast("string").alias("run"), F.col("keys").alias("x"), F.col("counts").alias("y"), F.lit(None).cast("binary").alias("z"))
    found = rare.unionByName(words).groupBy("bucket").applyInArrow(look_up, "run string, bucket long, x binary, y binary, z binary")
    n_all, v_all = model.n, model.v

    def combine(key, t):
        b = t.column("bucket").to_pylist()
        head = b.index(None)
        xs, ys, zs = (t.column(c).to_pylist() for c in "xyz")
        gain, known = np.frombuffer(xs[head], np.float64).copy(), np.frombuffer(ys[head], np.int64).copy()
        part = np.frombuffer(zs[head], np.float64)
        for i in sorted((i for i in range(len(b)) if i != head), key=lambda i: b[i]):
            who = np.frombuffer(xs[i], np.uint32)
            gain[who] += np.frombuffer(ys[i], np.float64)
            known[who] += np.frombuffer(zs[i], np.int64)
        ids = t.column("ids").combine_chunks()[head].values
        size = np.array(t.column("size")[head].as_py(), np.int64)
        return pa.table({id_col: ids, "held_out": pa.array(t.column("out")[head].as_py(), pa.bool_()), "n_tokens": size, "n_known": known,
                         "train_tokens": np.full(len(size), n_all, np.int64),
                         "base_score": gain - size * np.log10(float(n_all + v_all + 1)), "score": gain + part})

    heads = table.where("bucket is null").select("run", "ids", "out", "size", "bucket", "x", "y", "z")
    none = [F.lit(None).cast(heads.schema[c].dataType).alias(c) for c in ("ids", "out", "size")]
    parts = found.select("run", *none, "bucket", "x", "y", "z")
    return heads.unionByName(parts).groupBy("run").applyInArrow(
        combine, f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
