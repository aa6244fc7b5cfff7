"""events are dealt out by order key once, and a topic is made of them without a shuffle."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordwave.operators.sequence import dealer, partition_keys
from ordwave.schemas import ORDERS_TOPIC, PRICING_TOPIC
from ordwave.sources import fixtures
from ordwave.sources.tables import settings

LINE = ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, "
        "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")


@pytest.fixture
def tables(spark, tmp_path):
    """Own rows: unordered, nulls, lines that come twice, lines of no order or part, negative and far keys."""
    keys = [*range(-9, 400), 10**6]
    lines = [(k, n, k * n % 7, k % 5, float(n), 1.5, 0.05, "AR"[k % 2], "F", None) for k in reversed(keys) for n in range(1, 2 + k % 3)]
    lines += [lines[3], lines[3], (5, None, 1, 1, 1.0, 1.0, 0.1, None, None, None), (6, 9, 99, 1, 1.0, 1.0, 0.1, "A", "F", None),
              (None, 1, 1, 1, 1.0, 1.0, 0.1, "A", "F", None), (7777, 1, 1, 1, 1.0, 1.0, 0.1, "A", "F", None), (8, 8, 1, None, None, None, None, None, "O", None)]
    d = str(tmp_path / "sf")
    for name, rows, schema in (
            ("lineitem", lines, LINE),
            ("orders", [(k, k % 3, None, "1-URGENT" if k % 2 else None) for k in keys], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string"),
            ("customer", [(c, 0, None if c else "FURNITURE") for c in range(3)], "c_custkey bigint, c_nationkey int, c_mktsegment string"),
            ("part", [(p, f"bolt {p}" if p else None, "Brand#1", "LARGE", 1, 900.0) for p in range(7)],
             "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
            ("nation", [(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"), ("region", [(0, "R")], "r_regionkey int, r_name string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    return d


def placed(spark, tables, n, at):
    with settings(spark, fixtures.DEALT):
        fixtures.placed_rows(spark, tables, n).write.parquet(at)
    return spark.read.parquet(at)


def test_stretches_meet_in_their_partitions(spark):
    assert sorted(spark.createDataFrame([(v,) for v in partition_keys(spark, 7)], "v int").repartition(7, "v")
                  .select(F.spark_partition_id()).toPandas().iloc[:, 0]) == list(range(7))
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = dealer(rows, "k", 4)(rows, "k").groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("p").collect()
    assert len(got) == 4 and all(a.hi < b.lo for a, b in zip(got, got[1:])) and all(200 <= r.hi - r.lo <= 300 for r in got)


@pytest.mark.parametrize("slack", [60_000, -1])
def test_offsets_follow_the_total_order(spark, tables, tmp_path, monkeypatch, slack):
    """With stretches of the keys as files, and where the rows are shuffled by offset (-1)."""
    monkeypatch.setattr(fixtures, "SLACK", slack)
    root = fixtures.publish_topics(spark, tables, topics=(ORDERS_TOPIC, PRICING_TOPIC), force=True)
    for topic in (ORDERS_TOPIC, PRICING_TOPIC):
        rows = fixtures.ROWS[topic](fixtures.event_rows(spark, tables)).where("partition IS NOT NULL")
        w = Window.partitionBy("partition").orderBy("l_orderkey", "rank", "_copy")
        want = fixtures._records(rows.withColumn("offset", F.row_number().over(w).cast("bigint") - 1), topic)
        got = spark.read.parquet(f"{root}/{topic}")
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())) and got.count() > 700


def test_a_topic_is_made_without_a_shuffle_of_its_rows(spark, tables, tmp_path):
    rows = placed(spark, tables, 5, str(tmp_path / "placed"))
    plan = fixtures.placed_records(rows, ORDERS_TOPIC)._jdf.queryExecution().executedPlan().toString()
    main = plan[:plan.index("BroadcastExchange")]                # the block starts are broadcast
    assert "Exchange hash" not in main and "Exchange range" not in main and "SortMergeJoin" not in plan
    assert rows.inputFiles() and fixtures.advance_together(rows, ORDERS_TOPIC)


def test_lines_and_orders_are_not_shuffled_again_to_meet(spark, tables):
    with settings(spark, fixtures.DEALT):
        plan = fixtures.placed_rows(spark, tables, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan[:plan.index("SortMergeJoin")].count("Exchange") == 0                 # nor for the windows
    assert "hashpartitioning(l_orderkey" not in plan and "hashpartitioning(o_orderkey" not in plan


def test_partitions_apart_are_shuffled_by_offset(spark, tmp_path):
    """All records of one topic partition in the first stretch of keys, of the other in the second."""
    rows = spark.range(200).select((F.col("id") * 2 + F.floor(F.col("id") / 100)).alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
                                   F.floor(F.col("id") / 100).cast("int").alias("_r"), F.col("id").alias("_blk"),
                                   *(F.lit(None).alias(c) for c in ("l_quantity", "l_discount", "l_returnflag", "o_orderpriority", "c_mktsegment", "city", "region")))
    assert fixtures.advance_together(rows, PRICING_TOPIC)
    fixtures.SLACK, old = 99, fixtures.SLACK
    try:
        assert not fixtures.advance_together(rows, PRICING_TOPIC)
    finally:
        fixtures.SLACK = old


def test_files_are_read_in_the_order_of_broker_time(spark, tables):
    root = fixtures.publish_topics(spark, tables, topics=(ORDERS_TOPIC,), force=True).removeprefix("file:")
    files = sorted((f for f in os.listdir(f"{root}/{ORDERS_TOPIC}") if f.startswith("part-")), key=lambda f: os.path.getmtime(f"{root}/{ORDERS_TOPIC}/{f}"))
    first = [spark.read.parquet(f"{root}/{ORDERS_TOPIC}/{f}").agg(F.min("offset")).first()[0] for f in files]
    assert [x for x in first if x is not None] == sorted(x for x in first if x is not None) and len(files) > 2
