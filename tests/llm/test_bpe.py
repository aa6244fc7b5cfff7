import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from ordwave.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(PATH, P.PATTERN)


def ids_of(own, text):
    return [i for raw in own.encode_runs(text) for i in np.frombuffer(raw, "<u4").tolist()]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200) | st.text(alphabet="ab é\n1", max_size=300))
def test_any_text_as_the_library(library, own, text):
    assert ids_of(own, text) == library.encode_ordinary(text)


@pytest.mark.parametrize("piece", ["a" * 1000, "ab" * 700, "the" * 500, "é" * 400, "x1" * 100 + "y" * 333, "\n" * 500, "thethatthis" * 60])
def test_long_pieces_join_at_every_level(library, own, piece):
    assert ids_of(own, piece) == library.encode_ordinary(piece)
    assert [own.tokens[i] for i in own.tree(piece.encode())] == own.merge_long(piece.encode())


def test_pieces_of_documents_go_through_the_tree(spark, monkeypatch):
    """Leaves are single bytes, so nearly every distinct piece of more than one
    token is joined from halves; windows of more than two tokens occur too."""
    own, joins, wide = bpe.Bpe(PATH, P.PATTERN), [0], [0]
    join, window = bpe.Bpe.join, bpe.Bpe.window
    monkeypatch.setattr(bpe.Bpe, "join", lambda self, a, b: (joins.__setitem__(0, joins[0] + 1), join(self, a, b))[1])
    monkeypatch.setattr(bpe.Bpe, "window", lambda self, t: (wide.__setitem__(0, wide[0] + (len(t) > 2)), window(self, t))[1])
    texts = [r[0] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    pieces = {p for t in texts for p in own.pattern.findall(t) if p.encode() not in own.ranks}
    for p in pieces:
        own.piece_ids(p)
    assert joins[0] > len(pieces) > 1000 and wide[0] > 100


def test_white_space_is_the_librarys(library, own):
    for c in [*range(0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x2010), 0x2028, 0x202F, 0x205F, 0x3000, 0xFEFF]:
        text = f"a{chr(c)}b {chr(c)}{chr(c)} c"
        assert ids_of(own, text) == library.encode_ordinary(text), hex(c)


def test_operator_on_a_table(docs, corpus, library):
    got = sorted(tuple(r) for r in bpe.encode(docs, PATH, P.PATTERN).select("n_tokens", "ids_sha256", "decoded_sha256").collect())
    want = []
    for _, text, *_ in corpus:
        ids = library.encode_ordinary(text or "")
        want.append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_ids_decode_to_the_text(docs, own):
    for r in bpe.encode(docs.where("doc_id = 11 or doc_id = 402"), PATH, P.PATTERN).collect():
        assert hashlib.sha256(own.decode(list(r.ids))).hexdigest() == r.decoded_sha256


def test_runs_of_a_very_long_text(library, own, monkeypatch):
    text = "some words and 123 numbers, " * 400
    monkeypatch.setattr(bpe, "RUN", 100)
    monkeypatch.setattr(bpe, "CACHE", 3)
    assert ids_of(own, text) == library.encode_ordinary(text)


def test_empty_table(no_docs):
    assert bpe.encode(no_docs, PATH, P.PATTERN).count() == 0
