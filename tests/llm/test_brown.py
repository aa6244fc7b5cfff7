import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordwave.llm import brown, packed

from .conftest import words_of


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


@pytest.fixture(scope="module")
def scored(docs):
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7
    return brown.score(docs, fold != 2).collect()


def test_base_as_brute_force(scored, corpus):
    toks = [(i, [*words_of(t), "\n"]) for i, t, *_ in corpus]
    c = collections.Counter(w for i, ws in toks if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in toks)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored) == want


def test_score_is_a_log_probability(scored):
    assert all(r.score < 1e-9 for r in scored)
    assert any(r.score != r.base_score for r in scored)


def test_probabilities_sum_to_one(docs):
    m, counts = brown.fit(docs.select(F.col("text").alias("t")), "t", 6)
    used = np.unique(m.cls[np.concatenate((np.arange(len(m.states.keys)), np.arange(brown.WORDS, brown.END + 1)))])
    total = 10 ** m.step
    assert np.allclose(total.sum(1), 1)
    # emissions: words of each class, and one unseen word in the shape classes
    mass = np.zeros(len(m.denominator))
    for r in counts.collect():
        k, c = np.frombuffer(bytes(r["keys"]), np.uint64), np.frombuffer(bytes(r["counts"]), np.int64)
        np.add.at(mass, m.cls[m.states.of(k)], c + 1)
    mass[brown.CLASSES : brown.CLASSES + brown.SHAPES] += 1
    mass[-1] = m.ends + 1
    assert np.allclose(mass[used], 10 ** m.denominator[used])


def test_exchange_separates_two_kinds():
    rng = np.random.default_rng(0)
    pairs = np.zeros((brown.END + 1,) * 2, np.int64)
    kind = rng.integers(0, 2, 40)                       # words of one kind follow words of the other
    for _ in range(20000):
        a, b = rng.integers(0, 40, 2)
        if kind[a] != kind[b]:
            pairs[a, b] += 1
    cls = brown.cluster(pairs, 40, classes=2, sweeps=10)
    assert len(set(zip(cls[:40], kind))) == 2


def test_best_class_as_brute_force():
    rng = np.random.default_rng(1)
    n, k, c = 30, 4, 6                                   # words, classes, classes with those that words do not enter
    pairs = rng.poisson(0.7, (n + 2, n + 2)).astype(float)
    cls = np.concatenate((rng.integers(0, k, n), [4, 5]))
    cls[:5] = 4                                          # not clustered yet

    def matrix(cls):
        one = np.eye(c)[cls]
        return one.T @ pairs @ one

    one = np.eye(c)[cls]
    got = brown.best_classes(matrix(cls), (pairs @ one)[:n], (pairs.T @ one)[:n], pairs.diagonal()[:n], cls[:n], k)
    for w in range(n):
        value = [brown.likelihood(matrix(np.where(np.arange(n + 2) == w, x, cls))) for x in range(k)]
        assert value[got[w]] >= max(value) - 1e-7


def test_words_after_the_first_are_clustered(spark):
    """2,400 words as frequent as each other, in two kinds that take turns."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        odd, even = rng.integers(0, 1200, 60), rng.integers(0, 1200, 60)
        rows.append((i, " ".join(f"a{a}x b{b}x" for a, b in zip(odd, even))))
    docs = spark.createDataFrame(rows, "doc_id long, t string").repartition(3)
    m, counts = brown.fit(docs, "t", 6)
    keys = np.concatenate([np.frombuffer(bytes(r["keys"]), np.uint64) for r in counts.collect()])
    times = np.concatenate([np.frombuffer(bytes(r["counts"]), np.int64) for r in counts.collect()])
    cls = m.cls[m.states.of(keys)]
    assert len(keys) > 2 * brown.WORDS and (cls[times >= brown.LEAST] < brown.CLASSES).all()
    from pyarrow import array, large_string
    from ordwave.llm.textnum import blocks
    kind = {}
    for r in rows:
        k, _ = brown.tokens(next(blocks(array([r[1]], large_string()))))
        kind.update(zip(k.tolist(), [0, 1] * 60))
    learned = [(c, kind[k]) for k, c, x in zip(keys.tolist(), cls.tolist(), times) if x >= brown.LEAST]
    most = sum(max(collections.Counter(b for a, b in learned if a == c).values()) for c in {c for c, _ in learned})
    assert most >= 0.95 * len(learned)
    assert np.allclose((10 ** m.step).sum(1), 1)


def test_no_local_words_gives_the_same(docs, scored, monkeypatch):
    monkeypatch.setattr(brown, "LOCAL", 3)
    monkeypatch.setattr(packed, "FLUSH", 50)
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7
    again = brown.score(docs, fold != 2).collect()
    key = lambda rows: sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows)
    assert key(again) == key(scored)


def test_empty_table(no_docs):
    assert brown.score(no_docs, F.lit(True)).count() == 0
    assert brown.score(no_docs, F.lit(False)).count() == 0
