import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SYLLABLES = ["ka", "lo", "mi", "ren", "tu", "vas", "é", "über", "ñor", "sta", "pli", "gro"]
# columns that operators use inside: extra columns of these names must not matter
CLASH = "n long, entity string, keys string, id string, t string, w string, sh string, score string, predicted string, kept_text string, removed string, doc string"


def words_of(text):
    return WORD.findall((text or "").translate(LOW))


def shingles(text, k=5):
    w = words_of(text)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


class Prose:
    def __init__(self, seed):
        self.r = random.Random(seed)

    def word(self):
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 3)))

    def text(self, n, line=12):
        out = []
        for i in range(n):
            out.append(self.word())
            out.append("\n" if i % line == line - 1 else " ")
        return "".join(out).strip()

    def edited(self, text, rate):
        return " ".join(self.word() if self.r.random() < rate else w for w in text.split(" "))


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text, lang, source): clean prose, copies, near copies,
    shared passages, empty, null, very short and very long texts, null and
    repeated ids."""
    p = Prose(5)
    rows, i = [], 0
    for n in (0, 1, 2, 4, 5, 6, 9, 20, 50, 80, 150, 300, 700):
        for _ in range(3):
            rows.append((i, p.text(n) if n else "", "en" if i % 3 else "fr", f"s{i % 2}"))
            i += 1
    base = p.text(120)
    for k in range(14):                                   # a group of near copies
        rows.append((100 + k, p.edited(base, 0.006 * k), "en", "s0"))
    for k in range(9):                                    # a group of exact copies
        rows.append((200 + k, base.upper() if k % 2 else base, "en", "s0"))
    passage = p.text(60)
    for k in range(6):                                    # a passage inside other texts
        rows.append((300 + k, f"{p.text(70)} {passage} {p.text(40)}", "en", None))
    rows += [(400, None, None, None), (None, p.text(30), "en", "s0"), (None, None, None, None), (401, p.text(30000), "en", "s1"),
             (402, "a" * 5000, "en", "s1"), (403, "word " * 400, "en", "s1"), (404, "\n\n \t\n", "en", "s1"),
             (405, passage, "en", "s1"), (405, passage, "en", "s1"), (-7, base, "en", "s0")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with extra columns of clashing names."""
    extra = (None, "e", "k", "i", "t", "w", "s", "0.1", "1", "kt", "r", "d")
    return spark.createDataFrame([(*r, *extra) for r in corpus], f"doc_id long, text string, lang string, source string, {CLASH}").repartition(4).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
