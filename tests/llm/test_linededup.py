import collections
import re

import numpy as np
import pyarrow as pa
import xxhash

from ordwave.llm import linededup as ld
from ordwave.llm.textnum import blocks

from .conftest import Prose, words_of


def brute(rows):
    """Spans to remove, from the digests of each text by itself."""
    units = []
    for i, t in rows:
        b = next(blocks(pa.array([t or ""], pa.large_string())))
        digest, _, a, e, starts, ends, _ = ld.unit_digests(b)
        units.append((ld.NO_ID + (xxhash.xxh64_intdigest((t or '').encode(), 42) & (1 << 61) - 1) if i is None else i, digest, a, e, starts, ends, (t or "").encode()))
    keeper = {}
    for i, digest, *_ in units:
        for d in digest.tolist():
            keeper[d] = min(i, keeper.get(d, i))
    out = collections.Counter()
    for (i, digest, a, e, starts, ends, raw), (doc, _) in zip(units, rows):
        seen, cover = set(), np.zeros(len(starts) + 1, bool)
        for d, x, y in zip(digest.tolist(), a, e):
            if keeper[d] != i or d in seen:
                cover[x:y] = True
            seen.add(d)
        at = 0
        while at < len(starts):
            if not cover[at]:
                at += 1
                continue
            end = at
            while cover[end]:
                end += 1
            if end - at >= ld.MIN_WORDS:
                out[doc, len(raw[: starts[at]].decode()), len(raw[: ends[end - 1]].decode())] += 1
            at = end
    return out


def test_as_brute_force(docs, corpus):
    got = collections.Counter((r.doc_id, r.start, r.end) for r in ld.repeats(docs).collect())
    assert got == brute([r[:2] for r in corpus]) and got


def test_planted_passages_go_and_clean_texts_stay(spark):
    p = Prose(31)
    passages = [p.text(55, line=10**9) for _ in range(30)]
    rows = [(i, p.text(200)) for i in range(200)]
    for k, x in enumerate(passages):
        for c in range(3):
            rows.append((1000 + 10 * k + c, f"{p.text(40)} {x} {p.text(40)}"))
    got = {r.doc_id: r for r in ld.mark(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    assert all(not got[i].removed and got[i].kept_text == text[i] for i in range(200))
    for k, x in enumerate(passages):
        assert not got[1000 + 10 * k].removed
    later = [got[1000 + 10 * k + c] for k in range(30) for c in (1, 2)]
    assert sum(bool(r.removed) for r in later) >= 58
    for r in later:
        for s in r.removed:
            assert s.kept_doc_id < r.doc_id
            # a neighbouring word may happen to be the same in two copies
            span = words_of(text[r.doc_id][s.start : s.end])
            assert " ".join(span[2:-2]) in " ".join(words_of(passages[(r.doc_id - 1000) // 10]))


def test_kept_text_is_the_rest(docs, corpus):
    out = ld.clean(docs)
    assert out.columns == docs.columns and out.count() == len(corpus)
    marks = {r.doc_id: r for r in ld.mark(docs).collect()}
    text = {r[0]: r[1] for r in corpus}
    for i, r in marks.items():
        if i is None:
            continue
        t, pos, left = text[i] or "", 0, ""
        for s in r.removed:
            left += t[pos : s.start]
            pos = s.end
        assert left + t[pos:] == r.kept_text


def test_line_ends_and_case_do_not_matter(spark):
    p = Prose(4)
    x = p.text(60, line=9)
    loud = x.translate({97 + i: 65 + i for i in range(26)})
    rows = [(1, x), (2, loud.replace(" ", "  \t")), (3, None), (4, "")]
    got = {r.doc_id: r for r in ld.mark(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not got[1].removed and len(words_of(got[2].kept_text)) <= 12


def test_short_lines_go_by_brute_force(spark, corpus):
    """Every later copy of a line goes, also of one word and between other
    texts; the first stays, in the document of lowest id."""
    p = Prose(12)
    shared = ["All rights reserved", "x", p.text(9, line=10**9)]
    rows = [(i, "\n".join([p.text(40, line=10**9), (shared[i % 3] if i % 2 else "  " + shared[i % 3].upper() + "\t"), p.text(40, line=10**9)])) for i in range(12)]
    rows += [(50, f"one {p.word()} more\nin two\nother {p.word()} line\nIN  two"), (51, None), (52, "")]
    want, seen = collections.Counter(), {}
    for i, t in rows:
        for m in re.finditer(r"[^\n]+", t or ""):
            words = " ".join(words_of(m.group()))
            if words and seen.setdefault(words, i) is not None and (words, i) in want_first(rows, words, i, m.start()):
                s = m.start() + len(m.group()) - len(m.group().lstrip())
                want[i, s, m.start() + len(m.group().rstrip()), seen[words]] += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = collections.Counter((r.doc_id, r.start, r.end, r.kept_doc_id) for r in ld.repeats(docs, lines=True).collect())
    assert got == want and len(want) == 9
    assert not ld.repeats(docs).count()


def want_first(rows, words, doc, start):
    """(words, doc) if an earlier row or line has the words."""
    for i, t in rows:
        for m in re.finditer(r"[^\n]+", t or ""):
            if " ".join(words_of(m.group())) == words:
                return set() if (i, m.start()) == (doc, start) else {(words, doc)}
    return set()


def test_empty_table(no_docs):
    assert ld.repeats(no_docs).count() == 0


def test_rows_without_an_id_are_documents_of_their_own(spark):
    p = Prose(8)
    passage = p.text(60, line=10**9)
    rows = [(None, f"{p.text(30)} {passage}"), (None, f"{passage} {p.text(30)}"), ("x7", f"{p.text(20)} {passage} {p.text(9)}"), ("3", f"{p.text(40)} {passage}"), (None, None)]
    got = ld.mark(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert len(got) == 5
    cut = {r.doc_id: r.removed for r in got if r.doc_id}
    assert not cut["3"] and [s.kept_doc_id for s in cut["x7"]] == [3]
    assert sorted(len(r.removed) for r in got if r.doc_id is None) == [0, 1, 1]
    two = [r for r in got if r.doc_id is None and r.removed]
    assert all(passage[:40] not in r.kept_text for r in two)


def test_least_words_of_a_line(spark):
    rows = [(i, f"own{i} words here\nshort line\nthis line has got exactly eight words {'x' * 3}\nend{i}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for least, gone in ((1, ["short line", "this line has got exactly eight words xxx"]), (3, ["this line has got exactly eight words xxx"]), (9, [])):
        out = {r.doc_id: r.text for r in ld.clean(docs, lines=True, line_words=least).collect()}
        assert out[0] == rows[0][1]
        for i in (1, 2):
            want = rows[i][1]
            for g in gone:
                want = want.replace(g, "")
            assert out[i] == want
