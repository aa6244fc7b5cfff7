import re

from ordwave.llm import quality

from .conftest import WORD


def counts(text):
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    cover = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


def test_counts_as_brute_force(docs, corpus):
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.statistics(docs).collect() if r.doc_id is not None)
    assert got == sorted((i, *counts(t or "")) for i, t, *_ in corpus if i is not None)


def test_verdict(spark):
    from .conftest import Prose
    p = Prose(9)
    rows = [(i, p.text(40 + 3 * (i % 50)), "en", "a" if i % 3 else "b") for i in range(400)]
    rows += [(1000 + k, " ".join(f"{p.word()} |" for _ in range(80)), "en", "a") for k in range(5)]      # symbols
    rows += [(2000, "only a few words", "en", "a"), (2001, None, None, None), (2002, "again " * 100, "en", "a"),
             (2003, " ".join("#" * 30 for _ in range(60)), "xx", "rare")]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        n, _, _, _, rep = counts(text or "")
        assert got[i].base_failed == (n < 20 or 100 * rep > 30 * n)
        assert not (got[i].base_failed and got[i].kept)
    assert sum(got[i].kept for i in range(400)) >= 398
    assert not any(got[1000 + k].kept for k in range(5)) and not got[2003].kept


def test_null_and_empty(docs, corpus, no_docs):
    assert quality.judge(docs).count() == len(corpus)
    assert quality.judge(no_docs).count() == 0
