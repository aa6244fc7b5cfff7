import random

import numpy as np
import pytest

import __spark_entry__ as entry
from ordwave.llm import topk

SMALL = "/root/testdata/sf0.001"
MOST = 2**63 - 1


def brute(rows, asked, k):
    """Every row of another id, by score and id, for each distinct query row."""
    fine = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, v in {(i, v) for i, v in fine if asked(i)}:
        got = sorted((-min(max(sum(int(a) * int(b) for a, b in zip(v, w)), -MOST), MOST), j) for j, w in fine if j != i)[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(got)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], "vec_id long, embedding array<double>, id string, q int, vec string").repartition(3)


def run(spark, rows, asked, k=10):
    df = frame(spark, rows)
    some = [(i, v) for i, v in rows if i is not None and asked(i)]
    return sorted(tuple(r) for r in topk.top_k(df, frame(spark, some), k).select("query_id", "rank", "vec_id", "score").collect())


def test_random_vectors(spark):
    r = np.random.default_rng(1)
    centres = r.normal(0, 400, (6, 8))
    rows = [(i, np.floor(centres[i % 6] + r.normal(0, 30 if i % 2 else 300, 8)).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[5][1]) for i in range(300)]                      # one very common vector: ties
    assert run(spark, rows, lambda i: i % 50 == 0) == brute(rows, lambda i: i % 50 == 0, 10)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0]), (1, []), (2, None), (3, [None, 1.0]), (4, [float("nan")]), (5, [float("inf"), 0.0]),
            (None, [9.0, 9.0]), (6, [1.0, 2.0, 5.0]), (7, [-4.0, 0.0]), (8, [2.0**40, 2.0**40]), (9, [2.0**62, 1.0]), (10, [-(2.0**62), 1.0]), (6, [0.0])]
    got = run(spark, rows, lambda i: i in (0, 1, 6), 3)
    assert got == brute(rows, lambda i: i in (0, 1, 6), 3)
    big = run(spark, [(1, [2.0**62, 1.0]), (2, [2.0**62, 3.0]), (3, [4.0, 1.0])], lambda i: i == 1)
    assert big == [(1, 1, 2, MOST), (1, 2, 3, MOST)]


def test_nothing(spark):
    assert run(spark, [], lambda i: True) == []
    assert run(spark, [(1, [1.0])], lambda i: False) == []
    assert run(spark, [(1, [1.0])], lambda i: True) == []


def test_groups_of_queries(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 7)
    r = random.Random(3)
    rows = [(i, [float(r.randint(-9, 9)) for _ in range(4)]) for i in range(200)]
    assert run(spark, rows, lambda i: i % 4 == 0, 5) == brute(rows, lambda i: i % 4 == 0, 5)


def test_bounds_eliminate(spark):
    # far apart clusters: blocks of the others are never evaluated, and the result is that of brute force
    r = np.random.default_rng(5)
    pivots = np.eye(8) * 10_000
    x = np.floor(np.repeat(pivots, 512, 0) + r.normal(0, 20, (8 * 512, 8)))
    s = topk.Search(np.arange(0, len(x), 100), x[::100], pivots, 10)
    blocks = []
    for a in range(0, len(x), topk.ROWS):
        part = x[a : a + topk.ROWS]
        d = topk.distances(part, pivots)
        blocks.append((np.arange(a, a + len(part)), part, np.stack((d.min(0), d.max(0))), (part * part).sum(1).max()))
    s.slab(blocks)
    assert s.evaluated < 0.2 * len(x) * len(s.ids)
    p = (x[::100] @ x.T).astype(np.int64)
    p[np.arange(len(s.ids)), s.ids] = topk.NONE
    want = [sorted(range(len(x)), key=lambda j: (-row[j], j))[:10] for row in p.tolist()]
    assert s.who.tolist() == want


@pytest.mark.parametrize("name", ["op12_pivot_topk"])
def test_query(spark, name):
    got = entry.queries()[name](spark, SMALL).collect()
    rows = [(r[0], [float(np.floor(1024 * np.float64(x))) for x in r[1]]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(tuple(r) for r in got) == brute(rows, lambda i: i % 100 == 0, 10)
