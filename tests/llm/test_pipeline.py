"""The whole pipeline against its stages by brute force: texts compared with
texts, in Python, and the public library for the tokens. The toxicity model
is taken as trained (its own tests hold it against held-out labels)."""

import base64
import hashlib
import re

import numpy as np
import public_tokenizers as P
import tiktoken

import corpus_pipeline as pipeline
from ordwave.llm import toxicity

from . import test_decontaminate, test_jaccard, test_linededup
from .conftest import LOW, WORD

SMALL = "/root/testdata/sf0.001"


def not_toxic(spark, rows):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    good = {r.doc_id for r in scored if not r.predicted}
    return [r for r in rows if r[0] in good]


def one_of_each(rows):
    comp = {i: c for i, _, c in test_jaccard.brute(rows)}
    return [r for r in rows if comp[r[0]] == r[0]]


def without_repeats(rows):
    """Later copies of whole lines (of 8 words), and later runs of 30 words, cut out."""
    spans = {}
    for (i, lo, hi), k in test_linededup.brute(rows).items():
        assert k == 1
        spans.setdefault(i, []).append((lo, hi))
    seen = set()
    for i, text in sorted(rows):
        for line in re.finditer(r"[^\n]+", text):
            words = [(m.start(), m.end()) for m in WORD.finditer(line.group())]
            if len(words) >= pipeline.LINE_WORDS:
                key = tuple(WORD.findall(line.group().translate(LOW)))
                if key in seen:
                    spans.setdefault(i, []).append((line.start() + words[0][0], line.start() + words[-1][1]))
                seen.add(key)
    out = []
    for i, text in rows:
        gone = {c for lo, hi in spans.get(i, ()) for c in range(lo, hi)}
        out.append((i, "".join(ch for k, ch in enumerate(text) if k not in gone)))
    return out


def without_items(rows, items):
    bad = {i for i, *_ in test_decontaminate.brute(rows, items)}
    return [r for r in rows if r[0] not in bad]


def test_run_as_brute_force(spark):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    steps = [rows]
    for stage in (lambda x: not_toxic(spark, x), one_of_each, without_repeats, lambda x: without_items(x, items)):
        steps.append(stage(steps[-1]))
    assert len(rows) > len(steps[1]) > len(steps[2]) and sum(a != b for a, b in zip(steps[2], steps[3])) > 3 and len(steps[4]) < len(steps[3])
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, text in steps[4]:
        ids = library.encode_ordinary(text)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = pipeline.run(spark, SMALL).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)
