"""rows whose key comes once are not shuffled; the rows chosen are the same."""

import random

import pytest
from pyspark.sql import functions as F

from ordwave.operators import dedup
from ordwave.streaming.idindex import IdIndex


@pytest.mark.parametrize("slots", [1 << 29, 8, 1])
def test_first_per_key_however_many_slots_collide(spark, monkeypatch, slots):
    """Keys that come up to three times, NULL and blank ones, rows that repeat, NULLs in the order."""
    monkeypatch.setattr(dedup, "BLOCK", min(slots, 32_768))
    monkeypatch.setattr(dedup, "BLOCKS", max(1, slots // 32_768))
    r = random.Random(slots)
    rows = [(r.choice([None, "", " ", *(f"k{i}" for i in range(60))]), r.choice([None, 1, 2]), r.choice([None, 0.5, float("nan")]), r.choice("ab")) for _ in range(90)]
    df = spark.createDataFrame(rows + rows[:5], "key string, ts int, x double, other string").repartition(3)

    def order(row):
        return [(v is not None, ((1, 0.0) if v != v else (0, v)) if isinstance(v, float) else v) for v in row[1:]]
    want = {}
    for row in rows:
        keyed = row[0] is not None and row[0].strip()
        name = row[0] if keyed else repr(row)
        if name not in want or order(row) < order(want[name]):
            want[name] = row
    got = dedup.first_per_key(df, "key", ["ts"]).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.values()))


def test_rows_whose_key_comes_once_stay(spark, tmp_path):
    spark.range(500).select(F.concat(F.lit("k"), F.col("id") % 490).alias("key"), "id", F.lit("long text").alias("t")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    marks = dedup.repeated(df, "key")
    assert marks.agg(F.sum(F.bitmap_count("_bits"))).first()[0] == 10
    got = dedup.first_per_key(df, "key", ["id"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.split("\n") if "Exchange hashpartitioning(key" in line]
    assert len(shuffled) == 1 and "_bits" in plan[plan.index(shuffled[0]):] and "Union" in plan[:plan.index(shuffled[0])]     # only rows let through
    assert got.count() == 490


def test_keys_asked_for_may_repeat(spark, tmp_path):
    index = IdIndex(str(tmp_path))
    for batch, keys in enumerate((["a", "b"], ["c"])):
        index.add(spark.createDataFrame([(k,) for k in keys], "key string"), batch)
    asked = spark.createDataFrame([(k,) for k in ["c", "a", "a", "x", "x", None]], "key string")
    assert sorted(r.key for r in index.seen(asked, 2).collect()) == ["a", "c"]
