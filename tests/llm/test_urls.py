import pytest

from ordwave.llm import urls

from .conftest import CLASH

CASES = [
    ("https://WWW.Example.com/en/x", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("http://a.example.com/en/1?q=/fr/", "a.example.com", "/en/1", "example.com/en/", "block"),
    ("http://example.com/EN/1", "example.com", "/EN/1", "com/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://x.net/es/1#top", "x.net", "/es/1", "net/es/", "block"),
    ("http://x.net/fr", "x.net", "/fr", None, "allow"),
    ("http://x.org#frag/en", "x.org", "", None, "allow"),
    ("http://com/", "com", "/", "com/", "allow"),
    ("http://com", "com", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("a\nb://H.net/fr/\n?x", "h.net", "/fr/\n", "net/fr/", "block"),
    ("http://" + "p" * 5000 + ".org/" + "s/" * 5000, "p" * 5000 + ".org", "/" + "s/" * 5000, None, "allow"),
    ("x://y://z.net/fr/", "y:", "//z.net/fr/", None, "allow"),
]


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def test_host_path_and_fixed_rules(spark, no_labels):
    rows = [(k, c[0], *([None] * 12)) for k, c in enumerate(CASES)] + [(0, CASES[0][0], *([None] * 12)), (None, CASES[4][0], *([None] * 12))]
    got = urls.judge(spark.createDataFrame(rows, f"page_id long, url string, {CLASH}"), no_labels).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule, r.verdict) == CASES[r.page_id][1:], CASES[r.page_id][0]
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), no_labels).count() == 0


def test_mined_rules_as_brute_force(spark):
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        host = "spam.example.org" if bad or i % 40 == 1 else f"h{i % 7}.example.org"
        rows.append((i, f"https://{host}/{'ads' if bad else 'en'}/{i}{'?ref=x' if i % 2 else ''}"))
        labels.append((i, int(not bad), 0))
    pages, marks = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels + [(None, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    base = pages.withColumn("host", urls.host()).withColumn("path", urls.path()).withColumn("tokens", urls.tokens())
    sets = {r.page_id: frozenset(r.tokens) for r in base.collect()}
    found = urls.mine(base.select("page_id", "tokens"), marks, 0.05, 0.8).collect()
    assert found
    for r in found:
        hit = [i for i, s in sets.items() if set(r["items"]) <= s]
        assert len([i for i in hit if i % 4 == 0]) >= 20
        assert abs(r.confidence - sum(i % 4 == 0 for i in hit) / len(hit)) < 1e-9 and r.confidence >= 0.8
    want = {i: any(set(r["items"]) <= s for r in found) for i, s in sets.items()}
    got = {r.page_id: r.verdict == "block" for r in urls.judge(pages, marks, min_support=0.05, min_confidence=0.8).collect()}
    assert got == want and any(want.values()) and not all(want.values())


def test_no_rule_contains_a_more_general_one_as_confident(spark):
    rows = [(i, f"https://{'bad' if i % 2 else 'good'}.example.org/x") for i in range(100)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    marks = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(100)], "doc_id long, quality int, toxic int")
    base = pages.withColumn("host", urls.host()).withColumn("path", urls.path()).withColumn("tokens", urls.tokens())
    found = [(set(r["items"]), r.confidence) for r in urls.mine(base.select("page_id", "tokens"), marks, 0.05, 0.8).collect()]
    assert found and not any(a < b and ca >= cb for a, ca in found for b, cb in found)


def test_every_part_of_a_url_can_make_a_rule(spark):
    marks = ["https://m.casino-win.h{i}.org/a/{i}", "https://h{i}.org/{i}/deep/spam?x={i}", "https://h{i}.org/{i}?page={i}&evil={i}", "https://h{i}.org/{i}?page=1&mode=evil"]
    clean = "https://h{i}.org/{i}/deep/fine?page={i}&mode=good"
    rows = [(1000 * k + i, m.format(i=1000 * k + i)) for k, m in enumerate(marks) for i in range(40)] + [(9000 + i, clean.format(i=9000 + i)) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i >= 9000), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), labels).collect()
    assert all((r.verdict == "block") == (r.page_id < 9000) for r in got)


def test_least_rows_grow_slower_than_the_pages(spark):
    """30 bad pages of a host among 20,000: 0.15 % of them."""
    pages = spark.range(20000).selectExpr("id AS page_id", "concat('https://', if(id < 30, 'bad', concat('h', id)), '.org/', id) AS url")
    labels = spark.range(20000).selectExpr("id AS doc_id", "int(id >= 30) AS quality", "0 AS toxic")
    assert urls.judge(pages, labels).where("verdict = 'block'").count() == 30


def brute_verdicts(sets, bad, need, confidence):
    """Block what holds a token combination with enough bad rows and confidence
    (up to four tokens, over the distinct ones of ``bad`` pages)."""
    from itertools import combinations

    tokens = sorted({t for i in bad for t in sets[i]})
    tokens = [t for t in tokens if sum(t in sets[i] for i in bad) >= need]
    rules = []
    for k in (1, 2, 3, 4):
        for c in combinations(tokens, k):
            if any(set(r) <= set(c) for r in rules):
                continue
            hit = [i for i, s in sets.items() if set(c) <= s]
            if sum(i in bad for i in hit) >= need and sum(i in bad for i in hit) >= confidence * len(hit):
                rules.append(c)
    return {i: any(set(r) <= s for r in rules) for i, s in sets.items()}


def test_a_deep_url_that_repeats(spark):
    """30 copies of a URL of 25 segments: its tokens are one item, not 2^25
    sets, whatever their label; verdicts are those of brute force."""
    deep = "https://deep.example.org/" + "/".join(f"s{i}" for i in range(25))
    for bad_copies in (30, 12, 0):
        rows = [(i, deep) for i in range(30)] + [(30 + i, f"https://h{i % 3}.example.org/{'x' if i % 2 else 'y'}/{i}") for i in range(60)]
        rows += [(100, deep + "/more"), (101, "https://deep.example.org/s0/other")]
        bad = set(range(bad_copies)) | {30 + i for i in range(60) if i % 6 == 1}
        labels = spark.createDataFrame([(i, int(i not in bad), 0) for i, _ in rows[:90]], "doc_id long, quality int, toxic int")
        pages = spark.createDataFrame(rows, "page_id long, url string")
        got = {r.page_id: r.verdict == "block" for r in urls.judge(pages, labels, rules=[], min_rows=8).collect()}
        base = pages.withColumn("host", urls.host()).withColumn("path", urls.path()).withColumn("tokens", urls.tokens())
        deeper = {f"dir{k + 1}=s{k}" for k in range(1, 25)}                 # always with dir=s0: brute force without them
        small = {r.page_id: frozenset(r.tokens) - deeper for r in base.collect()}
        want = brute_verdicts({i: s for i, s in small.items() if i < 90}, bad, 8, 0.6)
        assert {i: got[i] for i in want} == want
        assert got[100] == (bad_copies == 30) and want[0] == (bad_copies == 30)


def test_combinations_of_tokens_none_of_which_is_enough(spark):
    """Bad only where a host and a directory meet."""
    rows, labels = [], []
    for i in range(320):
        h, d = i % 2, i // 2 % 2
        rows.append((i, f"https://{'ab'[h]}.example.org/{'xy'[d]}/{i}"))
        labels.append((i, int(not (h and d)), 0))
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rules=[]).collect()
    assert all((r.verdict == "block") == (r.page_id % 4 == 3) for r in got)
    assert {r.mined for r in got if r.mined} == {"dir=y host=b.example.org"}
