import hashlib
import random
import zlib

import numpy as np

import __spark_entry__ as entry
from ordwave.llm import periodic
from .conftest import WORD

SMALL = "/root/testdata/sf0.001"


def brute(words, least=12):
    """Runs by comparing a text with itself at every lag."""
    out = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def cut(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def find(texts, least=12):
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    ids = np.array([x for t in texts for x in t], np.int64)
    return [tuple(r) for r in periodic.find(ids, bounds, least).tolist()]


def test_runs_of_random_texts():
    r = random.Random(2)
    for _ in range(250):
        texts = []
        for _ in range(r.randint(1, 5)):
            k, n = r.choice((1, 2, 2, 3, 6, 40)), r.choice((0, 3, 11, 12, 13, 40, 90, 200))
            t = [r.randrange(k) for _ in range(n)]
            if n and r.random() < 0.6:
                a, p = r.randrange(n), r.randint(1, 60)
                t = [t[i] if i < a else t[min(n - 1, a + (i - a) % p)] for i in range(n)]
            texts.append(t if r.random() < 0.7 else t + t[::-1] + t + t)
        least = r.choice((12, 12, 4, 7, 20))
        assert find(texts, least) == [(d, *x) for d, t in enumerate(texts) for x in brute(t, least)]


def test_one_word_over_and_over():
    # one run, not a pair for each two occurrences
    assert find([[7] * 60_000]) == [(0, 0, 60_000, 1)]
    assert find([([1] * 50 + [2]) * 400])[1] == (0, 0, 20_400, 51)


def test_misleading_polynomials():
    # sums modulo a power of two cannot tell long stretches of this sequence apart
    t = [0]
    while len(t) < 4096:
        t += [1 - x for x in t]
    assert find([t]) == [(0, *x) for x in brute(t)]


def test_overlapping_and_nested_runs():
    x = [1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 2]
    assert find([x * 3]) == [(0, *r) for r in brute(x * 3)]


def test_documents(docs, corpus):
    got = {}
    for r in periodic.collapse(docs).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    want = {}
    for r in corpus:
        words = WORD.findall(r[1] or "")
        runs = brute(words) if len(words) < 5000 else []
        want.setdefault(r[0], []).append((len(words), runs, cut(words, runs)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert got[403] == [(400, [(0, 400, 1)], "word")]


def test_no_documents(no_docs):
    assert periodic.collapse(no_docs).collect() == []


def test_query_against_brute_force(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: r for r in entry.queries()["op11_periodic_runs"](spark, SMALL).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    assert got.keys() == texts.keys()
    planted = 0
    for doc_id, text in texts.items():
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        if n > 4000:
            continue
        runs = brute(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        r = got[doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert r.collapsed_sha256 == sha(cut(words, runs))
    assert planted > 5
