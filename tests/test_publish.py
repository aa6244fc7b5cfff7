"""The published topics: one shuffle of small rows, only the topics asked for."""

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from ordwave.config import work_root
from ordwave.operators import dims
from ordwave.operators.sequence import ranged_sequence
from ordwave.plans import landing, registry
from ordwave.schemas import ORDERS_TOPIC
from ordwave.sources import fixtures
from ordwave.streaming import sinks


def test_ranged_sequence_numbers_and_lays_out(spark):
    rows = spark.range(3000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 3).alias("g"), F.col("id").alias("tie"))
    got = ranged_sequence(rows.where("g < 2 OR k < 10"), "g", ["k", "tie"], "k", 5).withColumn("p", F.spark_partition_id())
    w = Window.partitionBy("g").orderBy("k", "tie")
    off = got.withColumn("want", F.row_number().over(w) - 1).where("seq <> want").count()
    assert off == 0 and got.count() == rows.where("g < 2 OR k < 10").count()
    stretch = got.groupBy("p").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi")).orderBy("p").collect()
    assert len(stretch) > 1 and all(a.lo < b.lo and a.hi <= b.hi for a, b in zip(stretch, stretch[1:]))


def test_ranged_sequence_of_nothing(spark):
    none = spark.range(0).select(F.col("id").alias("k"), F.col("id").alias("g"))
    assert ranged_sequence(none, "g", ["k"], "k", 3).collect() == []


def test_no_shuffle_or_sort_carries_the_json(spark, sf_small):
    plan = fixtures.order_records(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("rangepartitioning")]
    assert "AS _text" in above and "Sort" not in above[:above.rindex("AS _text")]
    assert "Exchange" not in above[:above.rindex("Exchange")]                 # the range shuffle is the last


def test_few_valued_texts_are_shuffled_as_numbers(spark, monkeypatch):
    """Nulls, empty texts and rows that come twice are put back as they were;
    columns of many combinations stay."""
    rows = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "a", ""), (4, "", "b"), (5, "a", None), (5, "a", None)],
                                 "n int, x string, y string")
    code, back = dims.coded(rows, ["x", "y"], "_c")
    small = code(rows)
    assert sorted(small.columns) == ["_c", "n"] and small.select("_c").distinct().count() == 4
    assert sorted(back(small).select("n", "x", "y").collect(), key=str) == sorted(rows.collect(), key=str)
    monkeypatch.setattr(dims, "BROADCAST_ROWS", 3)
    code, back = dims.coded(rows, ["x", "y"], "_c")
    assert back(code(rows)).collect() == rows.collect()


def test_topic_shuffle_has_no_few_valued_text(spark, sf_small):
    for made in (fixtures.order_records, fixtures.pricing_records):
        plan = made(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("rangepartitioning"):]
        shuffled = below[below.index("Project ["):].split("\n")[0]
        assert "_kind" in shuffled and "_line" in shuffled
        assert "brand" not in shuffled and "city" not in shuffled and "l_linestatus" not in shuffled


def test_a_query_of_one_topic_publishes_that_topic(spark, tmp_path, sf_small):
    sf = str(tmp_path / "sf")
    os.symlink(sf_small, sf)
    copy = str(tmp_path / "copy")
    os.mkdir(copy)
    for name in os.listdir(sf):
        os.symlink(os.path.realpath(f"{sf}/{name}"), f"{copy}/{name}")
    registry.records(spark, copy, ORDERS_TOPIC).count()
    root = fixtures.fixture_root(spark, copy).removeprefix("file:")
    assert sorted(os.listdir(root)) == [ORDERS_TOPIC, "staging"]


def test_landing_does_not_sort_by_status(spark, sf_small, monkeypatch):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    during = []
    compact = sinks.compact
    monkeypatch.setattr(sinks, "compact", lambda w, *a: during.append(spark.conf.get(key)) or compact(w, *a))
    out = landing.batch_load(spark, sf_small, f"{work_root(spark)}/unsorted-load")
    assert set(during) == {"2"} and spark.conf.get(key, None) == before
    files = [f for _, _, fs in os.walk(out["root"].removeprefix("file:") + "/orders") for f in fs if f.endswith(".parquet")]
    assert files and all(".zstd." in f for f in files)


def test_a_report_of_one_table_lands_that_stream(spark, tmp_path, sf_small):
    """and the other stream joins it in the same folder when it is read."""
    copy = str(tmp_path / "copy")
    os.mkdir(copy)
    for name in os.listdir(sf_small):
        os.symlink(os.path.realpath(f"{sf_small}/{name}"), f"{copy}/{name}")
    orders = registry.QUERIES["rows_per_day_stored"](spark, copy).count()
    topics = fixtures.fixture_root(spark, copy).removeprefix("file:")
    root = landing.shared_landing(spark, copy, tables=("orders",))
    assert sorted(os.listdir(topics)) == [ORDERS_TOPIC, "staging"]
    assert "pricing_events" not in os.listdir(root.removeprefix("file:"))
    assert landing.landed(spark, copy, "orders").groupBy("event_date").count().count() == orders
    got = registry.QUERIES["batch_reconciliation"](spark, copy).collect()
    assert landing.shared_landing(spark, copy) == root and "pricing_events" in os.listdir(root.removeprefix("file:"))
    assert all(r.n_in == r.n_landed + r.n_quarantined and r.n_in and not r.n_batches_off for r in got) and len(got) == 2
