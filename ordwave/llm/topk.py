"""Exact top-k inner products by pivot-table elimination.

Distances of every vector to ``PIVOTS`` pivots are precomputed. Sorted by
nearest pivot and distance to it, the vectors are written in blocks of ``ROWS``,
each with the least and the greatest distance of its members to every pivot:
its row of the pivot table (a bound for each member alone would cost as much as
its product). By the triangle inequality, the largest gap between a query's
distance to a pivot and that interval bounds the distance from below, and with
the norms the inner product from above.

Queries come in groups of about ``QUERIES``, broadcast one after the other.
Every task bounds all its blocks for all queries of the group, evaluates each
query's best-bound blocks first, and then the blocks in the order of their
bounds, each for the queries whose k-th best it could still reach. The rest is
eliminated, exactly. Each task hands over ``k`` rows a query, merged by rank.

Pivots are taken from the ``SAMPLE`` vectors of smallest hash, each the farthest
from those before; they decide the speed only. Driver and broadcast hold the
pivots and one group of queries.

Defined results: components are whole numbers (as doubles, below 2^63); products
beyond 64 bits are given as the nearest long. Rows without an id, and vectors
that are null or hold null or non-finite components, take no part. Rows with the
same id and vector count once; an id with several vectors is a candidate, and a
query, with each. A query's own id is never its candidate. A shorter vector counts as
followed by zeros. Ties go to the smaller id. Without vectors or queries there
are no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from . import scratch

PIVOTS = 64
SAMPLE = 1024
ROWS = 128               # vectors of a block
QUERIES = 4096           # of a group (and at most one more for each partition of the queries)
SLAB = 48 << 20          # bytes of blocks that a task works on at a time
FIRST = 3                # blocks of best bound that each query sees first
NONE = np.iinfo(np.int64).min


def whole(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
            .where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(~bad))


def matrix(col: pa.Array) -> np.ndarray:
    """Rows of doubles, shorter ones followed by zeros."""
    flat, at = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.concatenate(([0], np.cumsum(col.value_lengths().to_numpy())))
    sizes = np.diff(at)
    width = int(sizes.max()) if len(sizes) else 0
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(at[:-1], sizes)] = flat
    return out


def pad(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.concatenate((x, np.zeros((len(x), width - x.shape[1]))), 1)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    width = max(x.shape[1], pivots.shape[1])
    x, p = pad(x, width), pad(pivots, width)
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (p * p).sum(1) - 2 * (x @ p.T), 0))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    width = max(q.shape[1], x.shape[1])
    q, x = pad(q, width), pad(x, width)
    if len(q) == 0 or len(x) == 0 or np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, width) < 2.0**53:
        return (q @ x.T).astype(np.int64)
    big = [[sum(int(a) * int(b) for a, b in zip(u, v)) for v in x.tolist()] for u in q.tolist()]
    return np.array([[min(max(s, NONE + 1), -(NONE + 1)) for s in row] for row in big], np.int64).reshape(len(q), len(x))


def choose_pivots(rows: DataFrame) -> np.ndarray:
    """Up to ``PIVOTS`` vectors of a bounded sample, each far from the others."""
    got = rows.select("vec").orderBy(F.xxhash64("id", "vec")).limit(SAMPLE).toArrow()
    x = matrix(got.column("vec").combine_chunks())
    if not len(x):
        return x
    chosen, far = [0], distances(x, x[:1])[:, 0]
    while len(chosen) < min(PIVOTS, len(x)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, distances(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


def index(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The blocks: ids, vectors (32-bit where they fit), and the interval of
    their distances to each pivot."""
    box = rows.sparkSession.sparkContext.broadcast(pivots)

    def place(batches):
        for batch in batches:
            x = matrix(batch.column(1))
            d = distances(x, box.value)
            wide = (np.abs(x) >= 2.0**31).any(1)
            small = x.astype(np.int32) if not wide.any() else x
            sizes = batch.column(1).value_lengths().to_pylist()
            vecs = [(x[i] if wide[i] else small[i].astype(np.int32))[:n].tobytes() for i, n in enumerate(sizes)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(d.argmin(1).astype(np.int32)), pa.array(d.min(1)), pa.array(wide), pa.array(vecs, pa.binary())],
                                             ["id", "cell", "d", "wide", "vec"])

    def build(batches):
        held, last = [], None
        for batch in batches:
            key = list(zip(*(batch.column(c).to_pylist() for c in (0, 2, 3, 4))))
            new = [k for k, before in zip(key, [last, *key[:-1]]) if k != before]       # repeated rows are neighbours
            last = key[-1] if key else last
            held += new
            while len(held) >= ROWS:
                yield block(held[:ROWS])
                held = held[ROWS:]
        if held:
            yield block(held)

    def block(members):
        ids = np.array([m[0] for m in members], np.int64)
        vecs = [np.frombuffer(m[3], np.float64 if m[2] else np.int32).astype(np.float64) for m in members]
        width = max(len(v) for v in vecs)
        x = np.zeros((len(vecs), width))
        for i, v in enumerate(vecs):
            x[i, : len(v)] = v
        d = distances(x, box.value)
        wide = bool((np.abs(x) >= 2.0**31).any())
        return pa.RecordBatch.from_arrays(
            [pa.array([ids.tobytes()], pa.binary()), pa.array([(x if wide else x.astype(np.int32)).tobytes()], pa.binary()), pa.array([wide]),
             pa.array([np.stack((d.min(0), d.max(0))).tobytes()], pa.binary()), pa.array([float((x * x).sum(1).max())])],
            ["ids", "vecs", "wide", "table", "norm"])

    placed = rows.mapInArrow(place, "id long, cell int, d double, wide boolean, vec binary")
    return scratch.table(placed.repartitionByRange("cell", "d", "id").sortWithinPartitions("cell", "d", "id", "vec")
                         .mapInArrow(build, "ids binary, vecs binary, wide boolean, table binary, norm double"), "blocks")


class Search:
    """The ``k`` best of each query of a group among the blocks seen."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x, k
        self.norm, self.far = (x * x).sum(1), distances(x, pivots)
        self.best = np.full((len(ids), k), NONE)
        self.who = np.full((len(ids), k), NONE)
        self.evaluated = 0

    def bounds(self, table: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """(query, block): no member's product is greater."""
        gap = np.zeros((len(self.ids), len(norm)))
        for j in range(self.far.shape[1]):
            q = self.far[:, j, None]
            np.maximum(gap, q - table[None, :, 1, j], out=gap)
            np.maximum(gap, table[None, :, 0, j] - q, out=gap)
        most = self.norm[:, None] + norm[None, :]
        gap = np.maximum(gap - 1e-7 * np.sqrt(most), 0)                         # more than rounding can add
        return (most * (1 + 1e-9) - gap * gap) / 2 + 1

    def see(self, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        """Evaluate a block for some queries."""
        if not len(q):
            return
        self.evaluated += len(q) * len(ids)
        s = products(self.x[q], x)
        s[ids[None, :] == self.ids[q, None]] = NONE
        hit = (s >= self.best[q, -1:]) & (s > NONE)
        some = np.flatnonzero(hit.any(1))
        if not len(some):
            return
        use = np.flatnonzero(hit.any(0))
        q, s = q[some], np.where(hit, s, NONE)[np.ix_(some, use)]
        score = np.concatenate((self.best[q], s), 1)
        who = np.concatenate((self.who[q], np.broadcast_to(ids[use], s.shape)), 1)
        order = np.argsort(who, axis=1, kind="stable")
        score, who = np.take_along_axis(score, order, 1), np.take_along_axis(who, order, 1)
        order = np.argsort(~score, axis=1, kind="stable")[:, : self.k]          # ~x = -x - 1: descending, without overflow
        self.best[q], self.who[q] = np.take_along_axis(score, order, 1), np.take_along_axis(who, order, 1)

    def slab(self, blocks: list) -> None:
        bound = self.bounds(np.stack([b[2] for b in blocks]), np.array([b[3] for b in blocks]))
        first = np.argsort(-bound, axis=1, kind="stable")[:, :FIRST]
        for r in range(first.shape[1]):
            order = np.argsort(first[:, r], kind="stable")
            which, start = np.unique(first[order, r], return_index=True)
            for b, q in zip(which.tolist(), np.split(order, start[1:])):
                self.see(q[bound[q, b] >= self.best[q, -1]], *blocks[b][:2])
        np.put_along_axis(bound, first, -np.inf, 1)
        for b in np.argsort(-bound.max(0), kind="stable").tolist():
            self.see(np.flatnonzero(bound[:, b] >= self.best[:, -1]), *blocks[b][:2])


def search(blocks: DataFrame, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, k: int) -> DataFrame:
    """(q, query_id, vec_id, score): each task's best of every query."""
    box = blocks.sparkSession.sparkContext.broadcast((ids, x, pivots))

    def run(batches):
        ids, x, pivots = box.value
        s, held, size = Search(ids, x, pivots, k), [], 0
        for batch in batches:
            for ids_, vecs, wide, table, norm in zip(*(c.to_pylist() for c in batch.columns)):
                member = np.frombuffer(ids_, np.int64)
                v = np.frombuffer(vecs, np.float64 if wide else np.int32).astype(np.float64).reshape(len(member), -1)
                held.append((member, v, np.frombuffer(table, np.float64).reshape(2, -1), norm))
                size += v.nbytes + 8 * len(ids)
                if size >= SLAB:
                    s.slab(held)
                    held, size = [], 0
        if held:
            s.slab(held)
        q, r = np.nonzero(s.best > NONE)
        yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(ids[q]), pa.array(s.who[q, r]), pa.array(s.best[q, r])],
                                         ["q", "query_id", "vec_id", "score"])

    return blocks.mapInArrow(run, "q int, query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` with the
    greatest inner product with each row of ``queries`` (ids as in ``vectors``)."""
    spark = vectors.sparkSession
    rows = whole(vectors, id_col, vec_col)
    pivots = choose_pivots(rows)
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asked = scratch.table(whole(queries, id_col, vec_col).distinct().withColumn("row", F.monotonically_increasing_id()), "queries")
    groups = -(-asked.count() // QUERIES)
    if not len(pivots) or not groups:
        return none
    blocks = index(rows, pivots)
    order = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    parts = []
    for g in range(groups):
        got = asked.where(F.col("row") % groups == g).select("id", "vec").toArrow()
        found = search(blocks, got.column("id").to_numpy(), matrix(got.column("vec").combine_chunks()), pivots, k)
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best = best.select("query_id", "rank", "vec_id", "score")
        parts.append(best if groups == 1 else scratch.table(best, "group"))
    return reduce(DataFrame.unionAll, parts)
