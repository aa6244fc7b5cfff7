import random
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from ordwave.llm import collocations
from ordwave.llm.textnum import Block
from .conftest import LOW

SMALL = "/root/testdata/sf0.001"


def brute(rows, least=30, top=2000, longest=4):
    """rows: (doc_id, lang, text)."""
    f, n = Counter(), Counter()
    for doc_id, lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for m in range(1, min(longest, len(w) - i) + 1):
                    f[lang, tuple(w[i : i + m])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    gone = {(lang, w[i : i + m]) for (lang, w), b in cand.items() for m in range(2, len(w)) for i in range(len(w) - m + 1)
            if 100 * b >= 80 * f[lang, w[i : i + m]]}
    out = {}
    for (lang, w), a in cand.items():
        if (lang, w) in gone:
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted(((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, v in out.items()
                   for i, (s, a, p, l, r) in enumerate(sorted(v)[:top])), key=str)


def run(df, **kw):
    """The rows, after a look at the occurrence that each points to."""
    got = collocations.collocations(df, **kw).collect()
    texts = {}
    for r in df.select("doc_id", "lang", "text").collect():
        texts.setdefault((r.doc_id, r.lang if r.lang is not None else "und"), []).append(re.findall(r"[^\x20\x09-\x0D.,;:!?]+", (r.text or "").translate(LOW)))
    for r in got:
        w = r.phrase.split(" ")
        assert any(t[r.word : r.word + len(w)] == w for t in texts[r.doc_id, r.lang])
    return sorted((tuple(r)[:8] for r in got), key=str)


@pytest.mark.parametrize(("least", "longest", "top"), [(5, 4, 2000), (3, 3, 40), (30, 2, 5)])
def test_corpus(docs, corpus, least, longest, top):
    rows = [(r[0], r[2], r[1]) for r in corpus]
    got = run(docs, least=least, longest=longest, top=top)
    assert got == brute(rows, least, top, longest)
    assert got


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)


def test_pieces_languages_and_ties(spark):
    r = random.Random(4)
    words = ["Aa", "bb", "É", "cc", "aa", "\xa0x"]
    rows = [(i if i % 5 else None, r.choice(["en", "de", None, "und", ""]),
             "".join(r.choice(words) + r.choice([" ", "  ", "\t", ", ", "\n", " ", ".", "!?", "\x0b"]) for _ in range(r.choice((0, 1, 3, 60))))) for i in range(300)]
    rows += [(900, "en", None), (901, None, "new york new york new york"), (902, "en", " .. ,, \r\n")] + [(903, "xx", "a a a a a a a a a a")] * 5
    assert run(frame(spark, rows), least=30) == brute(rows, 30)


def test_words_and_comparison_of_bytes():
    p = collocations.Phrases(Block(0, np.frombuffer(b"aa bb, aa bb cc", np.uint8), np.array([0, 15])), np.zeros(1, np.uint64))
    assert p.of(2).tolist() == [0, 2, 3] and p.piece.tolist() == [1, 1, 2, 2, 2]
    text = np.frombuffer(b"abcdefghijk abcdefghijk abcdefghijx ", np.uint8)
    size = np.array([11, 11, 11, 3])
    assert collocations.differ(text, np.array([12, 24, 0, 0]), np.zeros(4, int), size, np.array([11, 11, 11, 4])).tolist() == [False, True, False, True]


def test_collisions_within_a_block(monkeypatch):
    """All phrases of the same fingerprint: their bytes, and the second
    fingerprint, tell them apart."""
    text = "aa bb cc aa bb dd"
    every = collocations.Bits(3, np.full(1, 255, np.uint8))
    monkeypatch.setattr(collocations.Phrases, "keys", lambda self, first, n: np.full(len(first), 7, np.uint64))
    p = collocations.Phrases(Block(0, np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])), np.zeros(1, np.uint64))
    o = collocations.Occurrences((1, 2), every, every)
    o.add(p, ["en"], np.array([5], np.uint64))
    key, check, f, at = o.held[0]
    got = {}
    for k, a in zip(f.tolist(), at.tolist()):
        word, n = (a & 0xFFFFFFFF) >> 4, a & 15
        assert a >> 32 == 5
        got[" ".join(text.split()[word : word + n])] = (k, word)
    assert got == {"aa": (2, 0), "bb": (2, 1), "cc": (1, 2), "dd": (1, 5), "aa bb": (2, 0), "bb cc": (1, 1), "cc aa": (1, 2), "bb dd": (1, 4)}
    assert o.words == {"en": 6} and len(set(check.tolist())) == 8 and set(key.tolist()) == {7}


def test_no_documents(no_docs):
    assert run(no_docs) == []


def test_query(spark):
    rows = [(r.doc_id, r.lang, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "text").collect()]
    got = sorted((tuple(r) for r in entry.queries()["op13_phrase_collocations"](spark, SMALL).collect()), key=str)
    assert got == brute(rows)
    assert got
