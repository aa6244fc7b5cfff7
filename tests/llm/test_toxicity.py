import numpy as np
import pyarrow as pa
import pytest

from ordwave.llm import toxicity as tox
from ordwave.llm.textnum import blocks

from .conftest import Prose

BAD = ["blorg", "snarfle", "zwock"]


@pytest.fixture(scope="module")
def labelled():
    p, rows = Prose(21), []
    for i in range(600):
        text = p.text(20 + i % 90).split(" ")
        toxic = int(i % 4 == 0)
        if toxic:
            text.insert(p.r.randrange(len(text)), BAD[i % 3] + ("" if i % 8 else p.word()))
        rows.append((i, " ".join(text), toxic))
    return rows


@pytest.fixture(scope="module")
def model(spark, labelled):
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled], "doc_id long, text string")
    marks = spark.createDataFrame([(i, y) for i, _, y in labelled if i % 5], "doc_id long, toxic int")
    return tox.train(docs, marks)


def test_held_out_accuracy_and_spans(spark, labelled, model):
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled], "doc_id long, text string")
    got = {r.doc_id: r for r in tox.score(docs, model).collect()}
    held = [(i, t, y) for i, t, y in labelled if i % 5 == 0]
    assert np.mean([got[i].predicted == y for i, _, y in held]) >= 0.97
    for i, t, y in held:
        assert 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.5)
        for s in got[i].spans:
            assert any(b in t[s.start : s.end].lower() for b in BAD) or not y


def test_forward_backward_as_enumeration():
    rng = np.random.default_rng(1)
    e, trans = rng.normal(0, 2, 6), rng.normal(0, 1, (2, 2))
    weight = {}
    for code in range(64):
        s = [(code >> k) & 1 for k in range(6)]
        weight[code] = np.exp(sum(e[k] * s[k] for k in range(6)) + sum(trans[s[k], s[k + 1]] for k in range(5)))
    want = [sum(w for c, w in weight.items() if (c >> k) & 1) / sum(weight.values()) for k in range(6)]
    assert np.allclose(tox.marginals(e, np.zeros(6, int), 1, trans), want)


def test_segments_of_long_and_empty_texts():
    owner = np.repeat([0, 2, 3], [tox.SEGMENT * 2 + 1, 1, tox.SEGMENT])
    starts, size = tox.segments(owner, 5)
    assert size.tolist() == [tox.SEGMENT, tox.SEGMENT, 1, 1, tox.SEGMENT] and size.sum() == len(owner)


def test_edges(docs, corpus, no_docs, model):
    got = tox.score(docs, model).collect()
    assert len(got) == len(corpus)
    assert all(r.score == 0 and not r.spans for r in got if r.doc_id in (0, 400, 404))
    assert tox.score(no_docs, model).count() == 0
    assert all(r.score == 0 for r in tox.score(docs, None).collect())


def test_labels_of_one_kind_or_none(spark, docs):
    assert tox.train(docs, spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")) is None
    assert tox.train(docs, spark.createDataFrame([], "doc_id long, toxic int")) is None


def test_offsets_are_characters(model):
    text = "é ü " * 30 + "blorg end"
    b = next(blocks(pa.array([text])))
    starts, ends, owner, keys = tox.token_features(b)
    p = np.zeros(len(starts))
    p[-2] = 0.9
    s = tox._spans(b, starts, ends, owner, p, np.array([0, len(starts)]), 0)[0]
    assert text[s["start"] : s["end"]] == "blorg"
