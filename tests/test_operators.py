"""Operators against brute force: dense sequencing, dedup, weighted buckets."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ordwave.operators.dedup import first_per_key
from ordwave.operators.sequence import dense_sequence
from ordwave.operators.weighted import SPACE, assign, hash32, ranges


def test_dense_sequence_matches_row_number(spark):
    # group 0 holds about a third of the rows (a hot group); small blocks so
    # the two-level prefix sums are exercised
    df = spark.range(0, 3000).select(
        (F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 3).cast("int").alias("g"),
        (F.col("id") % 5).alias("tie"))
    got = dense_sequence(df, "g", ["k", "tie"], "k", block=4, out="seq")
    want = df.withColumn("seq", F.row_number().over(Window.partitionBy("g").orderBy("k", "tie")) - 1)
    assert sorted(got.collect()) == sorted(want.collect())


def test_first_per_key(spark):
    rows = [("x", 2, None), ("x", 2, "c"), ("y", None, "q"), ("y", 5, "r")]
    blank = [("", 3, "b"), ("", 1, "z"), (" ", 1, "z"), (None, 1, "a"), (None, 2, "a")]
    df = spark.createDataFrame(rows + blank + blank[:2] + blank[-1:], "key string, ts int, other string")
    got = sorted(map(tuple, first_per_key(df, "key", ["ts"]).collect()), key=repr)
    assert got == sorted([("x", 2, None), ("y", None, "q"), *blank], key=repr)      # orders without an id are not one


def test_weighted_ranges_are_exact_and_reach_every_option(spark):
    weights = spark.createDataFrame([(i, f"o{i:06d}", 1 + i % 7) for i in range(20000)], "i long, opt string, weight int")
    total, at = sum(1 + i % 7 for i in range(20000)), 0
    want = []
    for i in range(20000):
        want.append((f"o{i:06d}", at * SPACE // total, (at + 1 + i % 7) * SPACE // total))
        at += 1 + i % 7
    for block in (None, "i"):
        got = sorted(map(tuple, ranges(weights, "opt", order="i", block=block).collect()))
        assert got == want


def test_weighted_assignment_follows_the_ranges(spark):
    weights = spark.createDataFrame([("a", 10), ("b", 30), ("c", 60), ("none", 0)], "opt string, weight int")
    options = ranges(weights, "opt")
    keys = spark.range(0, 20000).select(F.col("id").cast("string").alias("k"))
    got = assign(keys, "k", "s|", options, "b").withColumn("u", hash32("s|", "k")).collect()
    assert len(got) == 20000
    cut = [(r.opt, r.lo, r.hi) for r in options.collect()]
    assert sorted(o for o, *_ in cut) == ["a", "b", "c"] and max(h for *_, h in cut) == SPACE
    assert all([r.b] == [o for o, lo, hi in cut if lo <= r.u < hi] for r in got)
    n = [r.b for r in got]
    assert abs(n.count("c") / 20000 - 0.6) < 0.02 and abs(n.count("a") / 20000 - 0.1) < 0.02
    assert [r.b for r in assign(spark.createDataFrame([(None,)], "k string"), "k", "s|", options, "b").collect()] == [None]


def test_region_city_map_nested_form(spark, sf_small):
    from ordwave.operators.dims import region_city_map, region_city_pairs
    m = region_city_map(spark, sf_small).first().region_city
    pairs = {(r.region, r.city) for r in region_city_pairs(spark, sf_small).collect()}
    assert {(region, city) for region, v in m.items() for city in v.cities} == pairs
    assert sorted(v.weight for v in m.values()) == [10, 15, 20, 25, 30]
