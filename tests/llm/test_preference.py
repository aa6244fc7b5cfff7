from ordwave.llm import preference as pref

from .conftest import CLASH

COLS = f"pair_id long, turn long, role string, text string, {CLASH}"


def table(spark, rows):
    return spark.createDataFrame([(*r, *([None] * 12)) for r in rows], COLS)


def render(turns):
    return "".join(f"<|start|>{r}\n{t}<|end|>\n" for r, t in turns)


def brute(chosen, rejected):
    out = {}
    for key in {r[0] for r in chosen + rejected if r[0] is not None}:
        side = [[(r or "", t or "") for _, r, t in sorted(((-1 if x[1] is None else x[1], x[2] or "", x[3] or "") for x in rows if x[0] == key))] for rows in (chosen, rejected)]
        n = 0
        while n < min(map(len, side)) and side[0][n] == side[1][n]:
            n += 1
        out[key] = render(side[0][:n]), render(side[0][n:]), render(side[1][n:])
    return out


CHOSEN = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "more"), (1, 3, "assistant", "fine"),
          (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "user", "x"), (4, 0, "system", None), (4, None, None, "first"),
          (5, 0, "user", "same"), (5, 0, "user", "same"), (None, 0, "user", "lost"), (6, 0, "user", "q"), (6, 1, "assistant", "é" * 3000)]
REJECTED = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "more"), (1, 3, "assistant", "bad"), (1, 4, "user", "?"),
            (2, 0, "user", "a"), (2, 1, "assistant", "b"), (4, 0, "system", ""), (4, None, "", "first"), (5, 0, "user", "same"),
            (6, 0, "user", "q"), (6, 1, "assistant", ""), (7, 0, "user", "only rejected")]


def test_as_brute_force(spark):
    got = {}
    rows = pref.format_pairs(table(spark, CHOSEN), table(spark, REJECTED)).collect()
    for r in sorted(rows, key=lambda r: r.pos):
        text = got.setdefault((r.pair_id, r.part), [""])
        assert r.start == len(text[0])
        text[0] += r.rendered
        assert r.end == len(text[0])
        if r.mask_start is None:
            assert r.part == "prompt" or r.role != "assistant"
        else:
            assert r.part != "prompt" and r.role == "assistant"
            assert text[0][r.mask_start : r.mask_end].endswith("<|end|>") and text[0][: r.mask_start].endswith("assistant\n")
    for key, want in brute(CHOSEN, REJECTED).items():
        assert tuple(got.get((key, p), [""])[0] for p in ("prompt", "chosen", "rejected")) == want, key
    assert {k for k, _ in got} == {1, 2, 3, 4, 5, 6, 7}


def short(rows, conv):
    return sorted((r.part, r.pos, r.rendered.split("\n")[1].removesuffix("<|end|>")) for r in rows if r.conv_id == conv)


def test_pairs_from_conversations(spark):
    """Every turn of every conversation is in a part: with two answers or more,
    with one, with none, and after the last answer."""
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e"), (1, 5, "tool", "f"),
             (2, 0, "assistant", "only"), (None, 0, "assistant", "x"), (3, 0, "user", "q"), (3, 1, "user", "r"),
             (4, 0, "user", "q"), (4, 1, "assistant", "r"), (4, 2, None, None), (5, 0, "user", "q"), (5, 1, "assistant", "same"), (5, 2, "assistant", "same")]
    rows = pref.format_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    assert short(rows, 1) == [("chosen", 3, "d"), ("prompt", 0, "a"), ("prompt", 1, "b"), ("prompt", 2, "c"), ("rejected", 3, "b"), ("trailing", 4, "e"), ("trailing", 5, "f")]
    assert short(rows, 2) == [("chosen", 0, "only")]
    assert short(rows, 3) == [("prompt", 0, "q"), ("prompt", 1, "r")]
    assert short(rows, 4) == [("chosen", 1, "r"), ("prompt", 0, "q"), ("trailing", 2, "")]
    assert short(rows, 5) == [("prompt", 0, "q"), ("prompt", 1, "same"), ("prompt", 2, "same")]
    assert {r.conv_id for r in rows} == {1, 2, 3, 4, 5}
    trailing = sorted((r.start, r.end, r.mask_start) for r in rows if r.conv_id == 1 and r.part == "trailing")
    size = len("<|start|>user\ne<|end|>\n")
    assert trailing == [(0, size, None), (size, 2 * size, None)]


def test_a_conversation_longer_than_a_chunk(spark):
    """Numbers and offsets run on over the chunks of a long conversation."""
    n = 6_000
    turns = spark.range(n).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id) AS text")
    few = spark.range(40).selectExpr("id + 100 AS conv_id", "0L AS turn", "'assistant' AS role", "'x' AS text")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")             # small test chunks are not put together
    try:
        t = pref.numbered(turns.union(few), "conv_id")
        assert t.where("conv_id = 7").select("chunk").distinct().count() > 3
        rows = pref.format_conversations(turns.union(few)).where("conv_id = 7").orderBy("part", "pos").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert len(rows) == n + 1
    for part in ("prompt", "chosen", "rejected"):
        at = 0
        for r in (r for r in rows if r.part == part):
            assert r.start == at and r.end == at + len(r.rendered)
            at = r.end
    assert [r.pos for r in rows if r.part == "prompt"] == list(range(n - 1))
    assert [r.rendered for r in rows if r.part != "prompt"] == [f"<|start|>assistant\nt{k}<|end|>\n" for k in (n - 1, n - 3)]


def test_empty(spark):
    none = table(spark, [])
    assert pref.format_pairs(none, none).count() == 0
