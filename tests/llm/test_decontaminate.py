import pytest

from ordwave.llm import decontaminate as dec

from . import conftest
from .conftest import Prose


def shingles(text):
    return conftest.shingles((text or "").lower())


@pytest.fixture(scope="module")
def tables(spark, corpus):
    p = Prose(77)
    items = [(i, p.text(n)) for i, n in enumerate((3, 5, 6, 9, 14, 20, 33, 59, 59))] + [(20, None), (21, ""), (22, "two words"), (23, p.text(30)), (23, p.text(30))]
    items.append((24, corpus[30][1]))
    items.append((5, items[5][1]))
    rows = [r[:2] for r in corpus]
    for k, (_, t) in enumerate(items[:9]):
        rows.append((1000 + k, f"{p.text(200)} {t.upper()} {p.text(300)}"))       # whole
        rows.append((1100 + k, f"{p.text(50)} {p.edited(t, 0.04)} {p.text(50)}"))  # partly
    rows += [(1200, "two  words"), (1201, "two words more"), (None, items[6][1])]
    return rows, items


def brute(rows, items, threshold=0.75):
    out = set()
    for i, t in rows:
        s = shingles(t)
        for j, x in items:
            q = shingles(x)
            if q and len(s & q) >= threshold * len(q):
                out.add((i, j, len(q), len(s & q)))
    return out


def test_as_brute_force(spark, tables):
    rows, items = tables
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, text string, item long, sh string, w string").repartition(3)
    bench = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, dk long")
    got = {tuple(r)[:4] for r in dec.contaminated(docs, bench).collect()}
    assert got == brute(rows, items) and len(got) > 10
    kept = dec.clean(docs, bench)
    assert kept.columns == docs.columns
    dirty = {(i, t) for i, t in rows for _, x in items if shingles(x) and len(shingles(t) & shingles(x)) >= 0.75 * len(shingles(x))}
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted((r for r in rows if r not in dirty), key=str)


@pytest.mark.parametrize("threshold", [0.3, 0.5, 1.0])
def test_other_thresholds_miss_nothing(spark, tables, threshold):
    rows, items = tables
    got = {tuple(r)[:4] for r in dec.contaminated(spark.createDataFrame(rows, "doc_id long, text string"),
                                                  spark.createDataFrame(items, "item_id long, text string"), threshold).collect()}
    assert got == brute(rows, items, threshold)


def test_empty_tables(spark, tables, no_docs, docs):
    rows, items = tables
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert dec.contaminated(no_docs, bench).count() == 0
    assert dec.contaminated(docs, bench.limit(0)).count() == 0
    assert dec.clean(docs, bench.limit(0)).count() == docs.count()
