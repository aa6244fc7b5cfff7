"""Exact Jaccard join of word-shingle sets by count vectors in an R-tree.

Shingles are hashed into groups; the number of a set's shingles in each group
is its point. The overlap of two sets is at most the sum of the coordinate
minima of their points, and an R-tree over points bounds a whole node by the
sum of minima against the node's coordinate maxima. Pairs that survive the
bound are verified on the sets themselves.

To run on a cluster the join is first cut into cells. In a global order of
shingles (known frequent ones last, then by hash) two sets that link share
one of their first ``n - ceil(t n) + 1`` shingles, so a cell is such a
shingle with the sets that have it there. Sets are told apart by a hash of
their content, so any number of copies is one entry.

1. Cells are pruned where they meet: in the cell of their first common shingle
   the rest of both sets must still hold the overlap that a link needs, so a
   member without a partner of fitting size and place leaves the cell. Each cell
   proposes the pairs of its members with one of them (the least by hash, so that
   its cells agree); bound and verification give links, and components.
2. Large cells that still hold several components are searched with the R-tree,
   which proposes a spanning forest of the best bounds between components, at most a
   pair for each member. So a group of near copies costs about its size.
3. All cells that still hold several components are searched with the R-tree for
   all pairs across components. Cells beyond ``CELL`` members are dealt out in
   pairs of blocks.

Sets that share a frequent passage meet in many cells: of the cells of frequent
shingles, a pair with one among the first few of both sets is proposed in the
first of these only.

Every link is found: a linked pair shares the cell of its first common shingle;
it is in one component after steps 1 and 2, or proposed by step 3. No pair is
assumed linked without verification.

Defined results: null or empty texts, and texts without words, have an empty
set and link with nothing; rows with equal sets are linked; repeated ids are
separate rows; a null id is never a component's id unless the component has
no other; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import packed, scratch
from .textnum import U, blocks, doc_slices, mix, shingle_sets

HOT = 65_536         # frequent shingles put last in the order (order only: any order is exact)
HOT_TASK = 8_192     # of which a task proposes at most so many
CELL = 1_024         # members searched in one tree; larger cells go by pairs of blocks
LARGE = 64           # members of a cell that step 2 searches (speed only: step 3 finds the rest)
LEADS = 3            # first frequent shingles of a set's prefix that come with its point
NEAR = 64            # neighbours by size that a cell is pruned by; larger cells stay whole
FAN = 16             # entries of an R-tree node
BOUNDS = 1 << 20     # coordinates that are compared at a time
WHOLE = 128          # smaller sets keep all bytes of their keys
SLOTS = 1 << 20      # hash slots that pre-filter sets before they are shuffled


def group_count(n: int) -> int:
    """Groups of the count vector of a set of ``n``: about two shingles each."""
    return max(64, 1 << max(0, int(n // 2) - 1).bit_length())


def count_vector(keys: np.ndarray) -> np.ndarray:
    g = group_count(len(keys))
    v = np.bincount(((keys >> U(16)) & U(g - 1)).astype(np.int64), minlength=g)
    return v.astype(np.uint16) if v.max(initial=0) < 65536 else v.astype(np.uint32)


def store(keys: np.ndarray) -> bytes:
    """Sorted keys as their top 48 bits: cells use no more, and two sets are
    compared with each other only, where those bits tell shingles apart. The
    first byte says how many bytes of each key are kept whole. Of larger sets that is
    five, and the sixth is a bit for each key and value, set where a key has the value."""
    raw = keys.view(np.uint8).reshape(-1, 8)
    if len(keys) < WHOLE:
        return b"\6" + raw[:, 2:].tobytes()
    bits = np.zeros(len(keys) + 256, np.uint8)
    bits[raw[:, 7] + np.arange(len(keys))] = 1
    return b"\5" + raw[:, 2:7].tobytes() + np.packbits(bits).tobytes()


def stored(buf) -> np.ndarray:
    raw = np.frombuffer(buf, np.uint8)
    n = (len(raw) - 1) // 6 if raw[0] == 6 else (8 * (len(raw) - 1) - 256) // 41
    out = np.zeros((n, 8), np.uint8)
    if raw[0] == 6:
        out[:, 2:] = raw[1:].reshape(n, 6)
    else:
        out[:, 2:7] = raw[1 : 1 + 5 * n].reshape(n, 5)
        out[:, 7] = np.flatnonzero(np.unpackbits(raw[1 + 5 * n :])) - np.arange(n)
    return out.reshape(-1).view(np.uint64)


def packed_point(keys: np.ndarray) -> bytes:
    """The count vector in half a byte per group, rounded up in steps (first
    four bytes) if a count does not fit, so bounds stay bounds. Bits of one value
    stand together: the high ones are mostly zero, which the shuffle's codec sees."""
    v = count_vector(keys).astype(np.int64)
    step = max(1, -(-int(v.max(initial=0)) // 15))
    v = (-(-v // step)).astype(np.uint8)
    return np.uint32(step).tobytes() + np.packbits(v >> np.arange(4, dtype=np.uint8)[:, None] & 1, axis=1).tobytes()


def unpacked_point(raw: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(raw, np.uint8, offset=4).reshape(4, -1), axis=1)
    out = bits[0] | bits[1] << 1 | bits[2] << 2 | bits[3] << 3
    return out * np.frombuffer(raw, np.uint32, 1).astype(np.int32)


def fold(v: np.ndarray, g: int) -> np.ndarray:
    """A count vector (or a matrix of them) in ``g`` groups."""
    return v.reshape(*v.shape[:-1], -1, g).sum(-2, dtype=np.int32)


class Threshold:
    """``100 * intersection >= percent * union`` in integers."""

    def __init__(self, percent: int):
        self.p = percent

    def links(self, overlap, na, nb):
        return overlap * (100 + self.p) >= self.p * (na + nb)

    def sizes(self, na, nb):
        return np.minimum(na, nb) * 100 >= self.p * np.maximum(na, nb)

    def prefix(self, n: int) -> int:
        return n - -(-self.p * n // 100) + 1

    def room(self, n: int, take: int) -> np.ndarray:
        """Of the first ``take`` shingles of a set of ``n``: if it is the first
        that two sets share, the most that both sizes together can be for a
        link, as a part of ``n`` in steps of 1/64, rounded up (255: no limit)."""
        rest = n - np.arange(take)
        return np.minimum(-(-64 * (rest * (100 + self.p) // self.p) // n), 255).astype(np.uint8)

    def fit(self, na, nb, ra, rb):
        """Whether sets of these sizes and rooms can link through the cell."""
        both = na + nb
        return self.sizes(na, nb) & ((64 * both <= ra * na) | (ra == 255)) & ((64 * both <= rb * nb) | (rb == 255))


def rtree(points: np.ndarray) -> list[np.ndarray]:
    """Coordinate maxima of the nodes, level by level from the points up.
    The rows of ``points`` are packed in the order given."""
    levels = [points]
    while len(levels[-1]) > FAN:
        p = levels[-1]
        pad = -len(p) % FAN
        if pad:
            p = np.vstack((p, np.zeros((pad, p.shape[1]), p.dtype)))
        levels.append(p.reshape(-1, FAN, p.shape[1]).max(1))
    return levels


def tree_pairs(points: np.ndarray, n: np.ndarray, comp: np.ndarray, t: Threshold) -> np.ndarray:
    """Pairs ``i < j`` in different components whose bound admits a link, by ``i``, then ``j``.
    Points must be sorted by ``n``. All points go down the tree together, level by
    level; what sizes and components tell of a node is looked at before its bound is."""
    levels = rtree(points)
    first, least, most = [n], [comp], [comp]          # smallest set size of each node; smallest and largest component
    for below in levels[:-1]:
        at = np.arange(0, len(below), FAN)
        first.append(first[-1][at])
        least.append(np.minimum.reduceat(least[-1], at))
        most.append(np.maximum.reduceat(most[-1], at))
    q = np.repeat(np.arange(len(n)), len(levels[-1]))
    nodes = np.tile(np.arange(len(levels[-1])), len(n))
    step = max(1, BOUNDS // max(1, points.shape[1]))
    for depth in range(len(levels) - 1, -1, -1):
        low = np.maximum(first[depth][nodes], n[q])
        use = ((nodes + 1) * FAN**depth > q + 1) & (n[q] * 100 >= t.p * low) & ((least[depth][nodes] != comp[q]) | (most[depth][nodes] != comp[q]))
        q, nodes, low = q[use], nodes[use], low[use]
        bound = [np.minimum(levels[depth][nodes[k : k + step]], points[q[k : k + step]]).sum(1, dtype=np.int64) for k in range(0, len(q), step)]
        use = t.links(np.concatenate(bound), n[q], low) if bound else np.zeros(0, bool)
        q, nodes = q[use], nodes[use]
        if depth:
            q, nodes = np.repeat(q, FAN), (nodes[:, None] * FAN + np.arange(FAN)).ravel()
            q, nodes = q[nodes < len(levels[depth - 1])], nodes[nodes < len(levels[depth - 1])]
    order = np.lexsort((nodes, q))
    return np.stack((q[order], nodes[order]))


# -- sets -------------------------------------------------------------------
def set_table(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """A row per document: id, n, entity (hash of the set; null if empty) and
    keys. Rows of null ``n`` carry a task's frequent shingles."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        hot = {}
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            col = batch.column(1)
            for b in blocks(col):
                vals, owner = shingle_sets(b, size)
                n = len(b.bounds) - 1
                at = doc_slices(owner, n)
                u, c = np.unique(vals, return_counts=True)
                for k, x in zip(u[c >= 3].tolist(), c[c >= 3].tolist()):
                    hot[k] = hot.get(k, 0) + x
                if len(hot) > 16 * HOT_TASK:
                    hot = dict(heapq.nlargest(4 * HOT_TASK, hot.items(), key=lambda x: x[1]))
                size_ = np.diff(at)
                full = np.flatnonzero(size_)
                ent = np.zeros(n, np.int64)
                if len(full):
                    h = np.add.reduceat(mix(vals), at[full]) + U(3) * np.add.reduceat(mix(vals ^ U(0x5DEECE66D)), at[full])
                    ent[full] = mix(h + size_[full].astype(np.uint64)).view(np.int64)
                ent = pa.array(ent, mask=size_ == 0)
                keys = [store(vals[at[d] : at[d + 1]]) for d in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(b.first, n), pa.array(size_), ent, pa.array(keys, pa.binary()),
                     pa.nulls(n, pa.binary())], ["id", "n", "entity", "keys", "hot"])
        if hot:
            top = heapq.nlargest(HOT_TASK, hot.items(), key=lambda x: x[1])
            raw = (np.array(top, np.uint64) & np.array([~U(0xFFFF), ~U(0)], np.uint64)).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([raw], pa.binary())],
                ["id", "n", "entity", "keys", "hot"])

    src = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__t"))
    return scratch.table(src.mapInArrow(run, f"id {kind}, n long, entity long, keys binary, hot binary"), "sets")


def frequent(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most ``HOT`` frequent shingles, sorted, and their counts (1 MB)."""
    def run(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0].copy()), pa.array(x[:, 1].copy())], ["key", "c"])

    rows = sets.where("hot is not null").select("hot").mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))
    keys, counts = packed.most_frequent(scratch.table(rows, "frequent"), HOT)
    order = np.argsort(keys)
    return keys[order], counts[order]


def cells(sets: DataFrame, hot, t: Threshold, bits: int) -> tuple[DataFrame, DataFrame]:
    """Members of the cells with two or more different sets that fit:
    ``cell``, ``late`` (place of a frequent shingle, else 0), ``m``, ``entity``, ``n``, ``room``; and the
    pairs ``a, b, na, nb`` of one member (the least by hash) with each other one that fits."""
    def emit(batches):
        hk, hc = hot.value
        held, count = [], 0
        for batch in batches:
            ns, ents, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            for k, (n, e) in enumerate(zip(ns, ents)):
                s = stored(keys[k].as_buffer())
                take = t.prefix(n)
                if len(hk):
                    p = np.minimum(np.searchsorted(hk, s), len(hk) - 1)
                    h = hk[p] == s
                    if h.any():
                        s = np.concatenate((s[~h], s[h][np.argsort(hc[p[h]], kind="stable")]))
                held.append((s[:take].copy(), e, n, t.room(n, take)))
                count += take
            if count >= packed.FLUSH:
                yield from flush(held)
                held, count = [], 0
        if held:
            yield from flush(held)

    def flush(held):
        size = np.array([len(h[0]) for h in held])
        keys = np.concatenate([h[0] for h in held])
        ent = np.repeat(np.array([h[1] for h in held], np.int64), size)
        n = np.repeat(np.array([h[2] for h in held], np.uint32), size)
        room = np.concatenate([h[3] for h in held])
        order = np.lexsort((ent, keys))
        keys, ent, n, room = keys[order], ent[order], n[order], room[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (ent[1:] != ent[:-1])
        keys, ent, n, room = keys[new], ent[new], n[new], room[new]
        # a cell is known by its bucket and the next 32 bits; cells that fall together only cost time
        short = (keys >> U(32 - bits)).astype(np.uint32)
        rows = [(b, packed.planes(c, 4), e, packed.planes(k, 4), r) for b, _, c, e, k, r in packed.pack(bits, keys, short, ent, n, room)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["bucket", "cells", "entities", "ns", "rooms"])

    def gather(key, table):
        b = key[0].as_py()
        cell = packed.unplaned(table.column("cells"), np.uint32).astype(np.uint64)
        ent = packed.unpack(table.column("entities"), np.int64)
        n = packed.unplaned(table.column("ns"), np.uint32).astype(np.int64)
        room = packed.unpack(table.column("rooms"), np.uint8).astype(np.int64)
        order = np.lexsort((-room, ent, cell))
        cell, ent, n, room = cell[order], ent[order], n[order], room[order]
        new = np.ones(len(cell), bool)
        new[1:] = (cell[1:] != cell[:-1]) | (ent[1:] != ent[:-1])
        cell, ent, n, room = cell[new], ent[new], n[new], room[new]
        cell, ent, n, room = _pruned(cell, ent, n, room, t)
        start = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, np.int64)
        m = np.diff(np.append(start, len(cell)))
        sig = np.add.reduceat(mix(ent.view(np.uint64)), start) if len(start) else np.zeros(0, np.uint64)
        # the pairs of each cell's least member
        order = np.lexsort((mix(ent.view(np.uint64)), cell))
        head = np.repeat(order[start], m) if len(start) else np.zeros(0, np.int64)
        pair = np.flatnonzero(t.fit(n, n[head], room, room[head]) & (ent != ent[head])) if len(start) else head
        x, y = head[pair], pair
        _, one = np.unique(np.stack((ent[x], ent[y])), axis=1, return_index=True) if len(x) else (None, np.zeros(0, np.int64))
        x, y = x[one], y[one]
        # of the bucket's cells with the same members, the first in the order of shingles
        name = (U(b) << U(32)) | cell[start]
        last = place(name, *hot.value, bits)
        keep = np.zeros(len(start), bool)
        many = np.flatnonzero(m >= 3)
        many = many[np.lexsort((name[many], last[many]))]
        keep[many[np.unique(sig[many], return_index=True)[1]]] = True
        each = np.repeat(keep, m)
        wide = lambda z: np.repeat(z, m)[each]
        name, last = wide(name).view(np.int64), wide(last)
        none = pa.nulls(len(x), pa.int64())
        rows = len(name)
        return pa.table({"cell": pa.chunked_array([pa.array(name), none]), "late": pa.chunked_array([pa.array(last), none]),
                         "m": pa.chunked_array([pa.array(wide(m)), none]), "entity": np.concatenate((ent[each], ent[x])), "n": np.concatenate((n[each], n[x])),
                         "room": pa.chunked_array([pa.array(room[each]), none]),
                         "b": pa.chunked_array([pa.nulls(rows, pa.int64()), pa.array(ent[y])]), "nb": pa.chunked_array([pa.nulls(rows, pa.int64()), pa.array(n[y])])})

    rows = scratch.table(sets.where("entity is not null").select("n", "entity", "keys")
                         .mapInArrow(emit, "bucket long, cells binary, entities binary, ns binary, rooms binary")
                         .groupBy("bucket").applyInArrow(gather, "cell long, late long, m long, entity long, n long, room long, b long, nb long"), "cells")
    stars = rows.where("b is not null").select(F.col("entity").alias("a"), "b", F.col("n").alias("na"), "nb").distinct()
    return rows.where("cell is not null").select("cell", "late", "m", "entity", "n", "room"), stars


def _pruned(cell, ent, n, room, t: Threshold):
    """Members that fit another member of their cell, by cell and size. Cells
    of more than ``NEAR`` members stay as they are."""
    order = np.lexsort((ent, n, cell))
    cell, ent, n, room = cell[order], ent[order], n[order], room[order]
    if not len(cell):
        return cell, ent, n, room
    start = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    m = np.diff(np.append(start, len(cell)))
    keep = np.repeat(m > NEAR, m)
    left = np.repeat((m >= 2) & (m <= NEAR), m)
    for d in range(1, min(int(m.max()), NEAR)):
        i = np.flatnonzero(left[:-d] & (cell[:-d] == cell[d:]))
        if not len(i):
            break
        ok = i[t.fit(n[i], n[i + d], room[i], room[i + d])]
        keep[ok] = keep[ok + d] = True
    return cell[keep], ent[keep], n[keep], room[keep]


def _parted(cell, comp, n, room, t: Threshold) -> np.ndarray:
    """Which members of cells can link through their cell with a member of another
    component. The arrays are sorted by cell and size. Cells of more than ``CELL``
    members stay whole."""
    keep = np.zeros(len(cell), bool)
    if not len(cell):
        return keep
    start = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    m = np.diff(np.append(start, len(cell)))
    large = np.repeat(m > CELL, m)
    i, d = np.flatnonzero(~large[:-1]), 1
    while len(i):
        i = i[i + d < len(cell)]
        i = i[(cell[i] == cell[i + d]) & t.sizes(n[i], n[i + d])]
        ok = i[(comp[i] != comp[i + d]) & t.fit(n[i], n[i + d], room[i], room[i + d])]
        keep[ok] = keep[ok + d] = True
        d += 1
    return keep | large


# -- verification -----------------------------------------------------------
def _of(sets: DataFrame, ids: DataFrame, make, name: str, table: bool = True) -> DataFrame:
    """``entity`` and ``x`` (what ``make`` derives from the keys) of the sets in
    ``ids`` (column ``entity``), once each. Hash slots of the ids, a bounded
    table, filter the scan, so that only what is (almost surely) wanted is
    shuffled."""
    ids = scratch.table(ids.distinct(), name + "-ids")
    slot = F.pmod(F.xxhash64("entity"), F.lit(SLOTS)).cast("int")
    slots = F.broadcast(ids.select(slot.alias("slot")).distinct())        # at most SLOTS rows
    some = (sets.where("entity is not null").select("entity", "keys").withColumn("slot", slot).join(slots, "slot", "left_semi").drop("slot"))

    def derive(batches):
        for batch in batches:
            col = batch.column(1)
            x = [make(stored(col[k].as_buffer())) for k in range(len(col))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], ["entity", "x"])

    some = some.mapInArrow(derive, "entity long, x binary") if make else some.withColumnRenamed("keys", "x")
    once = some.join(ids, "entity", "left_semi").groupBy("entity").agg(F.first("x").alias("x"))
    return scratch.table(once, name) if table else once


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("entity"))


def _paired(pairs: DataFrame, sets: DataFrame, make, name: str) -> DataFrame:
    """The pairs with ``xa`` and ``xb``, what ``make`` derives from their sets.
    A set is shuffled once to its pairs; then that of ``a``, which may be in many pairs, goes
    to the other's, so no task holds more than the pairs of its own sets."""
    x = _of(sets, _ends(pairs), make, name, table=False)
    return pairs.join(x.toDF("a", "xa"), "a").join(x.toDF("b", "xb"), "b")


def _bounded(pairs: DataFrame, sets: DataFrame, t: Threshold) -> DataFrame:
    """Pairs ``a, b`` that the bound of their count vectors admits."""
    def run(batches):
        for batch in batches:
            x = batch.to_pydict()
            ok = []
            for na, nb, va, vb in zip(x["na"], x["nb"], x["xa"], x["xb"]):
                a, b = unpacked_point(va), unpacked_point(vb)
                g = min(len(a), len(b))
                ok.append(bool(t.links(int(np.minimum(fold(a, g), fold(b, g)).sum(dtype=np.int64)), na, nb)))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    both = _paired(scratch.table(pairs, "pairs"), sets, packed_point, "vectors")
    return both.select("a", "b", "na", "nb", "xa", "xb").mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, sets: DataFrame, t: Threshold, name: str) -> DataFrame:
    """The pairs ``a, b`` that link, by their sets."""
    def run(batches):
        for batch in batches:
            ok = []
            ka, kb = batch.column(2), batch.column(3)
            for k in range(batch.num_rows):
                a, b = stored(ka[k].as_buffer()), stored(kb[k].as_buffer())
                p = np.minimum(np.searchsorted(b, a), len(b) - 1)
                ok.append(bool(t.links(int((b[p] == a).sum()), len(a), len(b))))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    both = _paired(scratch.table(pairs.select("a", "b"), name + "-survivors"), sets, None, name + "-sets")
    return scratch.table(both.select("a", "b", "xa", "xb").mapInArrow(run, "a long, b long"), name)


def components(links: DataFrame) -> DataFrame:
    """``entity, comp`` of each linked set: smallest labels spread along links
    and labels follow labels, until nothing changes."""
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).toDF("entity", "other")
    label = scratch.table(both.groupBy("entity").agg(F.least(F.col("entity"), F.min("other")).alias("comp")), "labels")
    while True:
        near = (both.join(label.select(F.col("entity").alias("other"), F.col("comp").alias("c")), "other")
                .groupBy("entity").agg(F.min("c").alias("c")))
        step = label.join(near, "entity", "left").select("entity", F.col("comp").alias("old"), F.least("comp", F.coalesce("c", "comp")).alias("comp"))
        # follow the label's own label
        jump = label.select(F.col("entity").alias("comp"), F.col("comp").alias("c2"))
        new = scratch.table(step.join(jump, "comp", "left").select("entity", "old", F.least("comp", F.coalesce("c2", "comp")).alias("comp")), "labels")
        done = new.where("old != comp").limit(1).count() == 0
        scratch.drop_table(label)
        label = new.select("entity", "comp")
        if done:
            return label


def forest(i: np.ndarray, j: np.ndarray, comp: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Which pairs make a spanning forest of the components, best scores first."""
    root: dict = {}

    def find(x):
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    use = []
    for k in np.argsort(-score, kind="stable").tolist():
        a, b = find(int(comp[i[k]])), find(int(comp[j[k]]))
        if a != b:
            root[a] = b
            use.append(k)
    return np.array(use, np.int64)


def place(cell: np.ndarray, hot: np.ndarray, counts: np.ndarray, bits: int) -> np.ndarray:
    """From 1 on, where the cells of frequent shingles stand in the order of
    shingles; 0 for the others, which come before."""
    if not len(hot):
        return np.zeros(len(cell), np.int64)
    at = np.empty(len(hot), np.int64)
    at[np.lexsort((hot, counts))] = np.arange(1, len(hot) + 1)
    names = hot >> U(32 - bits)
    p = np.minimum(np.searchsorted(names, cell), len(hot) - 1)
    return np.where(names[p] == cell, at[p], 0)


def leads(keys: np.ndarray, hot: np.ndarray, counts: np.ndarray, t: Threshold, bits: int) -> np.ndarray:
    """Cells of the first ``LEADS`` frequent shingles of a set in the order of
    shingles, as far as they are in its prefix."""
    out = np.full(LEADS, ~U(0), np.uint64)
    if len(hot):
        p = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
        p = p[hot[p] == keys]
        room = t.prefix(len(keys)) - (len(keys) - len(p))                  # the others come first
        p = p[np.argsort(counts[p], kind="stable")][: max(0, min(LEADS, room))]
        out[: len(p)] = hot[p] >> U(32 - bits)
    return out


def first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """First lead that each pair of rows has in common; all bits set without one."""
    none = ~U(0)
    out = np.full(len(a), none, np.uint64)
    for x in range(LEADS - 1, -1, -1):
        for y in range(LEADS):
            out = np.where((a[:, x] == b[:, y]) & (a[:, x] != none), a[:, x], out)
    return out


def _across(members: DataFrame, sets: DataFrame, hot, label: DataFrame, t: Threshold, bits: int, least: int = 3, spanning: bool = False) -> DataFrame:
    """Pairs across components that the R-tree admits in some cell of ``least``
    members or more; ``spanning``: of each cell only a spanning forest of them."""
    mem = (members.where(F.col("m") >= least).select("cell", "late", "entity", "n", "room").join(label, "entity", "left")
           .withColumn("comp", F.coalesce("comp", "entity")))
    mixed = (mem.groupBy("cell").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"), F.first("late").alias("late"),
                                     F.sum(F.xxhash64("entity").cast("decimal(20,0)")).alias("sig"))
             .where(F.col("lo") != F.col("hi")).groupBy("sig").agg(F.min(F.struct("late", "cell", "m")).alias("one")).select("one.cell", "one.m"))
    mixed = scratch.table(mixed, "mixed")
    mem = mem.join(mixed, "cell")

    def parted(table):
        order = np.lexsort([table.column(c).to_numpy() for c in ("entity", "n", "cell")])
        keep = _parted(*(table.column(c).to_numpy()[order] for c in ("cell", "comp", "n", "room")), t)
        return table.take(order[keep]).drop(["part", "room"])

    # before their points are sent: members without a partner in another component leave the cell
    mem = (mem.select(F.pmod(F.xxhash64("cell"), F.lit(1 << bits)).alias("part"), "cell", "late", "entity", "n", "room", "comp", "m")
           .groupBy("part").applyInArrow(parted, "cell long, late long, entity long, n long, comp long, m long"))
    mem = scratch.table(mem, "parted")

    def point(keys):
        return leads(keys, *hot.value, t, bits).tobytes() + packed_point(keys)

    points = _of(sets, mem.select("entity"), point, "points")
    nb = F.ceil(F.col("m") / CELL).cast("int")
    mem = mem.withColumn("blocks", nb).withColumn("block", F.pmod(F.xxhash64("entity"), F.col("blocks")).cast("int"))
    # every pair of blocks once: (p, q) with p <= q holds the members of both
    mem = (mem.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .withColumn("p", F.least("block", "o")).withColumn("q", F.greatest("block", "o")).join(points, "entity")
           .select(F.pmod(F.xxhash64("cell", "p", "q"), F.lit(1 << bits)).alias("part"), "cell", "late", "p", "q", "entity", "comp", "n", "x"))

    def search(table):
        cols = {c: table.column(c).to_numpy() for c in ("cell", "late", "p", "q", "entity", "comp", "n")}
        # a set is in many cells: its point is unpacked once
        _, one, at = np.unique(cols["entity"], return_index=True, return_inverse=True)
        raw = table.column("x").take(one).to_pylist()
        leads_ = np.frombuffer(b"".join(x[: 8 * LEADS] for x in raw), np.uint64).reshape(-1, LEADS)
        points = [unpacked_point(x[8 * LEADS :]) for x in raw]
        widths = np.array([len(x) for x in points])
        order = np.lexsort((cols["entity"], cols["n"], cols["q"], cols["p"], cols["cell"]))
        place = np.stack([cols[c][order] for c in ("cell", "p", "q")])
        edge = np.concatenate(([0], np.flatnonzero((place[:, 1:] != place[:, :-1]).any(0)) + 1, [len(order)]))
        found = [np.zeros((4, 0), np.int64)]
        for lo, hi in zip(edge[:-1], edge[1:]):
            rows = order[lo:hi]
            if len(rows) < 2:
                continue
            lead, width = leads_[at[rows]], widths[at[rows]]
            here = U(int(cols["cell"][rows[0]]))
            for g in np.unique(width):
                # sets that may link have widths g and g, or g and 2 g
                use = np.flatnonzero((width == g) | (width == 2 * g))
                if len(use) > 1:
                    r = rows[use]
                    flat = np.stack([points[k] if len(points[k]) == g else fold(points[k], int(g)) for k in at[r]])
                    i, j = tree_pairs(flat, cols["n"][r], cols["comp"][r], t)
                    if cols["late"][rows[0]]:
                        first = first_common(lead[use[i]], lead[use[j]])
                        mine = (first == ~U(0)) | (first == here)
                        i, j = i[mine], j[mine]
                    if spanning and len(i):
                        size = cols["n"][r]
                        bound = np.concatenate([np.minimum(flat[i[k : k + 4096]], flat[j[k : k + 4096]]).sum(1) for k in range(0, len(i), 4096)])
                        best = forest(i, j, cols["comp"][r], bound / (size[i] + size[j]))
                        i, j = i[best], j[best]
                    i, j = r[i], r[j]
                    found.append(np.stack([cols[c][k] for c, k in (("entity", i), ("entity", j), ("n", i), ("n", j))]))
        a, b, na, nb = np.concatenate(found, axis=1)
        swap = mix(a.view(np.uint64)) > mix(b.view(np.uint64))
        a, b, na, nb = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)
        return pa.table({"a": a, "b": b, "na": na, "nb": nb})

    return mem.groupBy("part").applyInArrow(search, "a long, b long, na long, nb long").distinct()


def links(sets: DataFrame, percent: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """Verified links between different sets that connect all components, and
    the components ``entity, comp``."""
    t = Threshold(percent)
    hot = sets.sparkSession.sparkContext.broadcast(frequent(sets))
    members, stars = cells(sets, hot, t, bits)
    every = verify(_bounded(stars, sets, t), sets, t, "links0")
    label = components(every)
    for least, spanning in ((LARGE, True), (3, False)):
        more = verify(_across(members, sets, hot, label, t, bits, least, spanning), sets, t, "links")
        if not more.isEmpty():
            every = every.union(more)
            label = components(every)
    return every, label


def join(docs: DataFrame, percent: int = 75, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``n_shingles``, ``component_id``."""
    bits = packed.bucket_bits(docs)
    sets = set_table(docs, id_col, text_col, size)
    _, label = links(sets, percent, bits)
    rows = sets.where("n is not null").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "entity")
    rows = rows.join(label, "entity", "left").withColumn("comp", F.coalesce("comp", "entity"))
    # components of one row keep their id; copies are counted before they meet
    groups = rows.where("comp is not null").groupBy("comp").agg(F.min(id_col).alias("component_id"), F.count("*").alias("k")).where("k > 1").drop("k")
    return (rows.join(groups, "comp", "left")
            .select(id_col, "n_shingles", F.coalesce("component_id", F.col(id_col)).alias("component_id")))


def one_of_each(docs: DataFrame, percent: int = 75, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with one document of each component: the one whose
    id is the component's. An id stands for one document, so rows that repeat
    it stay or go together; documents with a null id or without words stay."""
    keep = join(docs.select(id_col, text_col), percent, size, id_col, text_col)
    gone = scratch.table(keep.where(F.col("component_id") != F.col(id_col)).select(id_col).distinct(), "copies")
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)
