"""Phrase collocation mining by Rabin-Karp fingerprints.

Words of a text are written back to back, lower-cased and one space apart; a
prefix polynomial over these bytes gives the fingerprint of any phrase within
a piece as the difference of two sums. Passes over the texts:

1. fingerprints of all words and pairs of words, reduced per task, meet in
   packed buckets, which keep those that occur ``least`` times or more;
2. the same for phrases of three words and more, all of whose pairs are
   frequent (a phrase is no more frequent than its parts);
3. occurrences whose fingerprint is frequent are compared, byte by byte, with
   the first of the block that has it. Their counts and a pointer (text, word)
   to one of them meet by fingerprint and a second, independent one, so that
   phrases which share the first in different tasks are told apart as well;
4. only texts that a frequent phrase points to are fetched, and the phrase is
   read there, after both fingerprints are computed anew: a phrase is
   materialised once, however many tasks have met it.

The passes know frequent fingerprints by a bitmap of 32 slots for each of
them, at most 2^28 slots (32 MB): what a full bitmap lets through is counted in
vain and falls out by its exact count. Nothing else is broadcast but a bitmap,
of the same bound, of the texts that are pointed to.

Scores, nesting and ranks are joins, grouped maxima and a limited window
over the frequent phrases, in exact decimals.

Defined results: a null text is empty; a null language is ``und`` (and one with
it); repeated rows and ids count each; the pointer's id is null where it is null
or no whole number; texts of 2^28 words and more are not pointed to (a phrase
that occurs beyond them only has none, and is an error); an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from . import packed, scratch
from .textnum import EXACT, U, Block, blocks, mix, span_keys

HELD = 1_200_000         # fingerprints that a task collects before it hands them over
SECOND = mix(EXACT ^ U(0x5851F42D4C957F2D)) | U(1)      # values of the second polynomial
SLOTS_LOG2 = 28          # of the largest bitmap
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09]] = True
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?"]] = True
BREAK[0x0A:0x0E] = True
LOW = np.arange(256, dtype=np.uint8)
LOW[65:91] += 32


class Phrases:
    """The words of a block: bytes ``text`` (lower case, one space after each
    word), where each starts and ends in them, its piece and its row."""

    def __init__(self, block: Block, langs: np.ndarray):
        start, end, self.row = block.runs(SPACE | BREAK)
        size = end - start
        self.end = np.cumsum(size + 1) - 1
        self.start = self.end - size
        total = int(self.end[-1]) + 1 if len(size) else 0
        from_ = np.repeat(start - self.start, size + 1) + np.arange(total)
        self.text = LOW[block.data[np.minimum(from_, max(0, len(block.data) - 1))]] if total else np.zeros(0, np.uint8)
        self.text[self.end] = 0x20
        breaks = np.concatenate(([0], np.cumsum(BREAK[block.data])))[start] if len(size) else start
        new = np.ones(len(size), bool)
        new[1:] = (breaks[1:] != breaks[:-1]) | (self.row[1:] != self.row[:-1])
        self.piece = np.cumsum(new)
        self.lang = langs
        self.prefix = Block(0, self.text, np.array([0, total])).prefix(EXACT)
        self.second = None

    def of(self, n: int) -> np.ndarray:
        """First words of the phrases of ``n`` words."""
        if len(self.piece) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[: len(self.piece) - n + 1] == self.piece[n - 1 :])

    def keys(self, first: np.ndarray, n) -> np.ndarray:
        return span_keys(self.prefix, self.start[first], self.end[first + n - 1]) ^ self.lang[self.row[first]]

    def checks(self, first: np.ndarray, n) -> np.ndarray:
        """The second fingerprint."""
        if self.second is None:
            self.second = Block(0, self.text, np.array([0, len(self.text)])).prefix(SECOND)
        return span_keys(self.second, self.start[first], self.end[first + n - 1]) ^ self.lang[self.row[first]]


def _lang_key(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _langs(col: pa.Array) -> tuple[list[str], np.ndarray]:
    names = col.to_pylist()
    key = {x: _lang_key(x) for x in set(names)}
    return names, np.array([key[x] for x in names], np.uint64)


@dataclass
class Bits:
    """Slots of the frequent fingerprints' top ``log2`` bits."""

    log2: int
    data: np.ndarray

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = (keys >> U(64 - self.log2)).astype(np.int64)
        return (self.data[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[start], np.add.reduceat(counts, start) if len(keys) else counts


def _fingerprints(p: Phrases, sizes, pairs) -> np.ndarray:
    """Fingerprints of all phrases of these sizes whose pairs are all frequent."""
    out = []
    ok = None
    if pairs is not None:
        ok = np.zeros(len(p.piece), bool)
        two = p.of(2)
        ok[two] = pairs.has(p.keys(two, 2))
    for n in sizes:
        first = p.of(n)
        if ok is not None:
            for k in range(n - 1):
                first = first[ok[first + k]]
        out.append(p.keys(first, n))
    return np.concatenate(out)


def count(docs: DataFrame, sizes, least: int, bits: int, pairs=None) -> DataFrame:
    """Per bucket: fingerprints of phrases of these sizes that occur ``least``
    times or more, sorted. ``pairs``: broadcast bitmap of the frequent pairs."""
    def emit(batches):
        held, size = [], 0
        for batch in batches:
            _, langs = _langs(batch.column(1))
            for b in blocks(batch.column(2)):
                p = Phrases(b, langs[b.first : b.first + len(b.bounds) - 1])
                held.append(np.unique(_fingerprints(p, sizes, pairs and pairs.value), return_counts=True))
                size += len(held[-1][0])
                if size >= HELD:
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
        k = k[c >= least]
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "keys": pa.array([k.tobytes()], pa.binary()), "n": pa.array([len(k)], pa.int64())})

    return scratch.table(docs.mapInArrow(emit, "bucket long, keys binary, counts binary")
                         .groupBy("bucket").applyInArrow(gather, "bucket long, keys binary, n long"), "fingerprints")


def bitmap(frequent: DataFrame, bits: int) -> Bits:
    """The bitmap of a table of packed ``keys`` (``n`` of them) per bucket of
    their top ``bits``, built per bucket, whose slots lie together."""
    n = frequent.agg(F.sum("n")).first()[0] or 0
    log2 = max(bits + 3, min(SLOTS_LOG2, int(32 * n).bit_length()))
    part = 1 << (log2 - bits - 3)

    def run(batches):
        for batch in batches:
            for b, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                on = np.zeros(part * 8, bool)
                on[(np.frombuffer(keys, np.uint64) >> U(64 - log2)).astype(np.int64) - b * part * 8] = True
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary())],
                                                 ["bucket", "slots"])

    data = np.zeros(1 << (log2 - 3), np.uint8)
    got = frequent.where("n > 0").select("bucket", "keys").mapInArrow(run, "bucket long, slots binary").toArrow()
    for b, s in zip(got.column("bucket").to_pylist(), got.column("slots").to_pylist()):
        data[b * part : (b + 1) * part] = np.frombuffer(s, np.uint8)
    return Bits(log2, data)


def differ(text: np.ndarray, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether the bytes from ``a`` on differ from those from ``b`` on, eight at a time."""
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(text) + 1,), "<u8", padded, strides=(1,))
    out = size_a != size_b
    left = np.flatnonzero(~out & (a != b))
    at = 0
    while len(left):
        rest = size_a[left] - at
        x = eight[a[left] + at] ^ eight[b[left] + at]
        x = np.where(rest >= 8, x, x & ((U(1) << (U(8) * np.minimum(rest, 7).astype(np.uint64))) - U(1)))
        out[left] = x != 0
        left = left[(x == 0) & (rest > 8)]
        at += 8
    return out


def _reduce(keys, checks, counts, at) -> list[np.ndarray]:
    """Sum of the counts and least pointer of each pair of fingerprints, by the first."""
    order = np.lexsort((checks, keys))
    keys, checks, counts, at = keys[order], checks[order], counts[order], at[order]
    if not len(keys):
        return [keys, checks, counts, at]
    start = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1]))))
    return [keys[start], checks[start], np.add.reduceat(counts, start), np.minimum.reduceat(at, start)]


def pointers(row: np.ndarray, word: np.ndarray, n: np.ndarray) -> np.ndarray:
    """32 bits of the text's key, 28 of the word's number, 4 of the phrase's size."""
    at = row << U(32) | word.astype(np.uint64) << U(4) | n.astype(np.uint64)
    return np.where(word < 1 << 28, at, ~U(0))


class Occurrences:
    """Frequent fingerprints of a task: count and least pointer."""

    def __init__(self, sizes, few: Bits, many: Bits):
        self.sizes, self.few, self.many = sizes, few, many
        self.held: list = []
        self.size = 0
        self.words: dict[str, int] = {}

    def add(self, p: Phrases, names: list, rows: np.ndarray) -> None:
        first_word = np.searchsorted(p.row, np.arange(len(names) + 1))
        for name, k in zip(names, np.diff(first_word).tolist()):
            self.words[name] = self.words.get(name, 0) + k
        ok, parts = np.zeros(len(p.piece), bool), []
        for n in self.sizes:
            first = p.of(n)
            if n > 2:
                for k in range(n - 1):
                    first = first[ok[first + k]]
            key = p.keys(first, n)
            hit = (self.few if n <= 2 else self.many).has(key)
            if n == 2:
                ok[first[hit]] = True
            parts.append((key[hit], first[hit], np.full(int(hit.sum()), n)))
        key, first, n = (np.concatenate(x) for x in zip(*parts))
        if not len(key):
            return
        at = pointers(rows[p.row[first]], first - first_word[p.row[first]], n)
        order = np.argsort(key, kind="stable")
        key, first, n, at = key[order], first[order], n[order], at[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        lead, group = np.flatnonzero(new), np.cumsum(new) - 1
        s, e = p.start[first], p.end[first + n - 1]
        other = differ(p.text, s, s[lead][group], e - s, (e - s)[lead][group]) | (p.lang[p.row[first]] != p.lang[p.row[first[lead]]][group])
        counts, least = np.bincount(group[~other], minlength=len(lead)), np.minimum.reduceat(np.where(other, ~U(0), at), lead)
        apart = np.flatnonzero(other)                       # another phrase of the same fingerprint
        use = np.concatenate((lead, apart))
        self.held.append(_reduce(key[use], p.checks(first[use], n[use]), np.concatenate((counts, np.ones(len(apart), np.int64))),
                                 np.concatenate((least, at[apart]))))
        self.size += len(use)


FOUND = "bucket long, keys binary, checks binary, counts binary, at binary, lang string, words long"


def occurrences(docs: DataFrame, sizes, bits: int, words: Bits, longer: Bits, least: int) -> DataFrame:
    """Per bucket: fingerprints of the frequent phrases, their counts and
    pointers; and, in buckets below zero, the words of each language."""
    sc = docs.sparkSession.sparkContext
    few, many = sc.broadcast(words), sc.broadcast(longer)

    def emit(batches):
        o = Occurrences(sizes, few.value, many.value)
        for batch in batches:
            names, langs = _langs(batch.column(1))
            rows = batch.column(3).to_numpy().view(np.uint64) >> U(32)
            for b in blocks(batch.column(2)):
                last = b.first + len(b.bounds) - 1
                o.add(Phrases(b, langs[b.first : last]), names[b.first : last], rows[b.first : last])
                if o.size >= HELD:
                    yield flush(o)
        yield flush(o)
        yield pa.RecordBatch.from_arrays([pa.array([-1 - _lang_key(x) % 64 for x in o.words], pa.int64()), *(pa.nulls(len(o.words), pa.binary()) for _ in range(4)),
                                          pa.array(list(o.words), pa.string()), pa.array(list(o.words.values()), pa.int64())], NAMES)

    def flush(o):
        cols = _reduce(*(np.concatenate(c) for c in zip(*o.held))) if o.held else [np.zeros(0, np.uint64)] * 4
        o.held, o.size = [], 0
        rows = list(zip(*packed.pack(bits, cols[0], cols[1], cols[2].astype(np.int64), cols[3]))) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), *(pa.array(c, pa.binary()) for c in rows[1:]), pa.nulls(len(rows[0]), pa.string()),
                                           pa.nulls(len(rows[0]), pa.int64())], NAMES)

    def gather(key, table):
        if key[0].as_py() < 0:
            sums = table.group_by("lang").aggregate([("words", "sum")])
            n = len(sums)
            return pa.Table.from_arrays([pa.nulls(n, pa.int64()).fill_null(key[0].as_py()), *(pa.nulls(n, pa.binary()) for _ in range(4)), sums.column("lang"),
                                         sums.column("words_sum").cast(pa.int64())], NAMES)
        kinds = (np.uint64, np.uint64, np.int64, np.uint64)
        cols = _reduce(*(packed.unpack(table.column(c), t) for c, t in zip(NAMES[1:5], kinds)))
        cols = [c[cols[2] >= least] for c in cols]
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int64()), *(pa.array([c.tobytes()], pa.binary()) for c in cols), pa.nulls(1, pa.string()),
                                     pa.array([len(cols[0])], pa.int64())], NAMES)

    NAMES = ["bucket", "keys", "checks", "counts", "at", "lang", "words"]
    return scratch.table(docs.mapInArrow(emit, FOUND).groupBy("bucket").applyInArrow(gather, FOUND), "occurrences")


def fetch(docs: DataFrame, found: DataFrame, bits: int) -> DataFrame:
    """(lang, phrase, n, f, doc_id, word) of the phrases that ``found`` points to."""
    def unpack(batches):
        for batch in batches:
            key, check, f, at = (packed.unpack(batch.column(c), t) for c, t in enumerate((np.uint64, np.uint64, np.int64, np.uint64)))
            if (at == ~U(0)).any():
                raise ValueError("a frequent phrase occurs only beyond 2^28 words of its texts")
            yield pa.RecordBatch.from_arrays([pa.array((at >> U(32)).view(np.int64)), pa.array((at & U(0xFFFFFFFF)).view(np.int64)), pa.array(key.view(np.int64)),
                                              pa.array(check.view(np.int64)), pa.array(f)], ["row", "at", "key", "check", "f"])

    places = scratch.table(found.where("bucket >= 0").select("keys", "checks", "counts", "at")
                           .mapInArrow(unpack, "row long, at long, key long, check long, f long"), "places")

    def pack_rows(key, table):
        rows = np.unique(table.column("row").to_numpy().view(np.uint64)) << U(32)
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "keys": pa.array([rows.tobytes()], pa.binary()), "n": pa.array([len(rows)], pa.int64())})

    rows = places.select(F.shiftright("row", 32 - bits).alias("bucket"), "row").distinct()
    wanted = docs.sparkSession.sparkContext.broadcast(
        bitmap(scratch.table(rows.groupBy("bucket").applyInArrow(pack_rows, "bucket long, keys binary, n long"), "rows"), bits))

    def choose(batches):
        for batch in batches:
            row = batch.column(3).to_numpy().view(np.uint64) >> U(32)
            hit = np.flatnonzero(wanted.value.has(row << U(32)))
            _, one = np.unique(batch.column(3).to_numpy()[hit], return_index=True)         # copies of a text: one of a batch
            hit = np.sort(hit[one])
            yield pa.RecordBatch.from_arrays([pa.array(row[hit].view(np.int64)), *(batch.column(c).take(pa.array(hit)) for c in (0, 1, 2, 3))],
                                             ["row", "id", "lang", "text", "whole"])

    texts = (docs.mapInArrow(choose, "row long, id long, lang string, text string, whole long")
             .groupBy("row", "whole").agg(F.min(F.struct("id", "lang", "text")).alias("t")).select("row", "t.*"))
    lists = places.groupBy("row").agg(F.collect_list(F.struct("at", "key", "check", "f")).alias("p"))

    def read(batches):
        for batch in batches:
            _, langs = _langs(batch.column(1))
            for b in blocks(batch.column(2)):
                last = b.first + len(b.bounds) - 1
                p = Phrases(b, langs[b.first : last])
                mine = batch.column(3).slice(b.first, last - b.first)
                sizes = mine.value_lengths().to_numpy()
                flat = mine.flatten()
                at, key, check, f = (flat.field(c).to_numpy() for c in range(4))
                owner = np.repeat(np.arange(len(sizes)), sizes)
                start = np.searchsorted(p.row, np.arange(len(sizes) + 1))
                word, n = at >> 4, at & 15
                first = start[owner] + word
                ok = np.flatnonzero(first + n <= start[owner + 1])                          # else the pointer of another text
                ok = ok[p.piece[first[ok]] == p.piece[first[ok] + n[ok] - 1]]
                ok = ok[(p.keys(first[ok], n[ok]).view(np.int64) == key[ok]) & (p.checks(first[ok], n[ok]).view(np.int64) == check[ok])]
                text = p.text.tobytes()
                phrase = [text[s:e].decode() for s, e in zip(p.start[first[ok]].tolist(), p.end[first[ok] + n[ok] - 1].tolist())]
                of = pa.array(owner[ok] + b.first)
                yield pa.RecordBatch.from_arrays([batch.column(1).take(of), pa.array(phrase, pa.string()), pa.array(n[ok].astype(np.int32)), pa.array(f[ok]),
                                                  batch.column(0).take(of), pa.array(word[ok])], ["lang", "phrase", "n", "f", "doc_id", "word"])

    return (texts.join(lists, "row").select("id", "lang", "text", "p")
            .mapInArrow(read, "lang string, phrase string, n int, f long, doc_id long, word long").dropDuplicates(["lang", "phrase"]))


def phrases(docs: DataFrame, least: int = 30, longest: int = 4, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n, f, doc_id, word): all phrases of up to ``longest`` words
    that occur ``least`` times or more in a language, and where; and (lang, n): its words."""
    lang, text = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.expr(f"try_cast(`{id_col}` AS bigint)").alias("id"), lang.alias("lang"), text.alias("text"), F.xxhash64(lang, text).alias("whole"))
    bits = min(packed.bucket_bits(docs), SLOTS_LOG2 - 3)
    words = bitmap(count(src, (1, 2), least, bits), bits)
    pairs = docs.sparkSession.sparkContext.broadcast(words)
    longer = bitmap(count(src, range(3, longest + 1), least, bits, pairs), bits) if longest > 2 else words
    found = occurrences(src, range(1, longest + 1), bits, words, longer, least)
    return scratch.table(fetch(src, found, bits), "phrases"), found.where("bucket < 0").select("lang", F.col("words").alias("n"))


def _joined(a: str, b: str) -> str:
    return f"array_join(slice(w, {a}, {b}), ' ')"


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, nested_percent: int = 80, top: int = 2000,
                 id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The first ``top`` phrases of each language by score: lang, rank, phrase,
    a, l, r, n, score, and the first occurrence (doc_id, word)."""
    frequent, words = phrases(docs, least, longest, id_col, text_col, lang_col)
    candidate = frequent.where("n > 1").select("lang", "phrase", F.col("n").alias("size"), F.col("f").alias("a"), F.struct("doc_id", "word").alias("at"), F.split("phrase", " ").alias("w"))

    # the longer phrases that hold a candidate: of each, its inner phrases, reduced before the join
    inner = candidate.where("size > 2").select("lang", "a", F.explode(F.expr(
        f"array_distinct(flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> {_joined('i', 'm')}))))")).alias("phrase"))
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = (candidate.join(around, ["lang", "phrase"], "left")
            .where(F.expr(f"longer IS NULL OR CAST(100 AS DECIMAL(20,0)) * longer < CAST({nested_percent} AS DECIMAL(20,0)) * a")).drop("longer"))

    cut = kept.select("*", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cut = cut.select("lang", "phrase", "a", "at", "k", F.expr(_joined("1", "k")).alias("left"), F.expr(_joined("k + 1", "size - k")).alias("right"))
    left = frequent.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    score = F.expr("CAST((CAST(2000000 AS DECIMAL(20,0)) * a) DIV (CAST(l AS DECIMAL(20,0)) + r) AS BIGINT)").alias("score")
    cuts = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"]).select("lang", "phrase", "a", "at", F.struct(score, "k", "l", "r").alias("cut"))
    lowest = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("at").alias("at"), F.min("cut").alias("cut"))

    order = W.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = lowest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "at.doc_id", "at.word")
