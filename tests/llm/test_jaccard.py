import itertools

import numpy as np
import pyarrow as pa
import pytest

from ordwave.llm import jaccard, packed
from .conftest import shingles


def brute(rows, percent=75):
    sets = [shingles(t) for _, t, *_ in rows]
    par = list(range(len(rows)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            par[find(j)] = find(i)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    out = []
    for i, r in enumerate(rows):
        ids = [x for x in groups[find(i)] if x is not None]
        out.append((r[0], len(sets[i]), min(ids) if ids else None))
    return out


def test_as_brute_force(docs, corpus):
    got = [tuple(r) for r in jaccard.join(docs).collect()]
    assert sorted(got, key=str) == sorted(brute(corpus), key=str)


@pytest.mark.parametrize("cell,fan", [(3, 2), (5, 16)])
def test_blocks_of_large_cells(docs, corpus, monkeypatch, cell, fan):
    monkeypatch.setattr(jaccard, "CELL", cell)
    got = [tuple(r) for r in jaccard.join(docs, percent=60).collect()]
    assert sorted(got, key=str) == sorted(brute(corpus, 60), key=str)


def test_one_document_of_each_group_stays(docs, corpus):
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    want = sorted((i for i, _, comp in brute(corpus) if i is None or comp == i), key=str)
    assert sorted((r.doc_id for r in kept.select("doc_id").collect()), key=str) == want


def test_empty_table(no_docs):
    assert jaccard.join(no_docs).count() == 0


def test_bound_admits_every_link():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate((a[: int(n * rng.uniform(0.7, 1))], rng.integers(0, 1 << 63, int(rng.integers(0, n // 5 + 1)), dtype=np.uint64)))
        if not len(b):
            continue
        va, vb = jaccard.count_vector(a), jaccard.count_vector(b)
        g = min(len(va), len(vb))
        both = len(np.intersect1d(a, b))
        assert np.minimum(jaccard.fold(va, g), jaccard.fold(vb, g)).sum() >= both
        wa, wb = (jaccard.fold(jaccard.unpacked_point(jaccard.packed_point(x)), g) for x in (a, b))
        assert np.minimum(wa, wb).sum() >= both
    many = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    same = np.concatenate((many, np.repeat(many[:1], 3000)))       # a count beyond a byte
    assert (jaccard.unpacked_point(jaccard.packed_point(same)) >= jaccard.count_vector(same)).all()
    few = np.sort(many[:100]) & ~np.uint64(0xFFFF)
    assert (jaccard.stored(jaccard.store(np.sort(many[:100]))) == few).all()


def test_tree_finds_what_the_bound_admits():
    rng = np.random.default_rng(4)
    t = jaccard.Threshold(75)
    n = np.sort(rng.integers(20, 60, 150))
    pts = np.stack([np.bincount(rng.integers(0, 8, k), minlength=8) for k in n])
    comp = rng.integers(0, 5, 150)
    want = {(i, j) for i in range(150) for j in range(i + 1, 150)
            if comp[i] != comp[j] and t.sizes(n[i], n[j]) and t.links(np.minimum(pts[i], pts[j]).sum(), n[i], n[j])}
    assert set(map(tuple, jaccard.tree_pairs(pts, n, comp, t).T.tolist())) == want and want


def test_stored_sets_and_planes_are_lossless():
    rng = np.random.default_rng(7)
    for n in (1, 2, jaccard.WHOLE - 1, jaccard.WHOLE, 333, 5000, 70_000):
        keys = np.sort(rng.integers(0, 2**64, n, dtype=np.uint64))
        for k in (keys, keys >> np.uint64(9), keys | np.uint64(0xFF << 56), np.zeros(n, np.uint64)):
            raw = jaccard.store(k)
            assert (jaccard.stored(raw) == k & ~np.uint64(0xFFFF)).all() and len(jaccard.stored(raw)) == n
            assert len(raw) <= 1 + 6 * n
    assert len(jaccard.store(keys)) < 0.87 * 6 * len(keys)
    numbers = [np.arange(5, dtype=np.uint32) * 70_000, np.array([1 << 31], np.uint32), np.zeros(0, np.uint32)]
    col = pa.chunked_array([pa.array([packed.planes(x.tobytes(), 4) for x in numbers], pa.binary())])
    assert packed.unplaned(col, np.uint32).tolist() == np.concatenate(numbers).tolist()


def test_a_set_is_shuffled_once_for_each_pair(spark):
    """Of a pair, the set of its first side goes to the other's place."""
    sets = spark.createDataFrame([(e, jaccard.store(np.arange(e, e + 200, dtype=np.uint64) << np.uint64(40))) for e in range(1, 5)], "entity long, keys binary")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (4, 3)], "a long, b long")
    got = {(r.a, r.b): (bytes(r.xa), bytes(r.xb)) for r in jaccard._paired(pairs, sets, None, "test").collect()}
    keys = {r.entity: bytes(r["keys"]) for r in sets.collect()}
    assert got == {(a, b): (keys[a], keys[b]) for a, b in ((1, 2), (1, 3), (1, 4), (4, 3))}
    plan = jaccard._paired(pairs, sets, None, "test")._jdf.queryExecution().optimizedPlan().toString()
    assert "max(" not in plan                             # no set of both sides meets in an aggregate by pair


def test_members_without_a_partner_in_another_component_leave():
    """As by all pairs of each cell; cells that are too large stay whole."""
    t, rng = jaccard.Threshold(75), np.random.default_rng(3)
    cell, n = np.sort(rng.integers(0, 60, 400)), rng.integers(20, 400, 400)
    cell = np.append(cell, np.full(jaccard.CELL + 1, 99))
    n = np.append(n, rng.integers(1, 10**6, jaccard.CELL + 1))
    comp, room = rng.integers(0, 3, len(cell)), rng.integers(100, 150, len(cell))
    order = np.lexsort((n, cell))
    cell, comp, n, room = (x[order] for x in (cell, comp, n, room))
    want = [c == 99 or any(comp[i] != comp[j] and bool(t.fit(n[i], n[j], room[i], room[j])) for j in np.flatnonzero(cell == c))
            for i, c in enumerate(cell)]
    got = jaccard._parted(cell, comp, n, room, t)
    assert got.tolist() == want and not all(want[:400]) and any(want[:400])
    assert len(jaccard._parted(*(x[:0] for x in (cell, comp, n, room)), t)) == 0
