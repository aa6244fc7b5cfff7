"""Invariants across reports."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from ordwave.operators.dedup import first_per_key
from ordwave.plans import landing


def test_rows_per_day_sum_to_row_count(spark, sf_small):
    q = E.queries()
    per_day = q["orders_rows_per_day"](spark, sf_small).agg(F.sum("n")).first()[0]
    summary = {r.table_name: r.n for r in q["table_summary"](spark, sf_small).collect()}
    assert per_day == summary["orders"]


def test_mix_shares_sum_to_one_per_parent(spark, sf_small):
    mix = E.queries()["mix_audit"](spark, sf_small)
    sums = mix.groupBy("dimension", "parent").agg(F.sum("share").alias("s"), F.sum("weight_share").alias("w"),
                                                  F.sum("n").alias("n"))
    for r in sums.collect():
        if r.n:
            assert abs(r.s - 1.0) < 1e-9, r
        if r.w is not None:
            assert abs(r.w - 1.0) < 1e-9, r


def test_dedup_is_idempotent(spark, sf_small):
    orders = landing.landed(spark, sf_small, "orders")
    order = ["timestamp"]
    once = first_per_key(orders, "order_id", order)
    twice = first_per_key(once, "order_id", order)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    ids = orders.where("order_id <> ''").select("order_id").distinct().count()
    blank = orders.where("order_id = ''").distinct().count()
    assert once.count() == ids + blank and blank > 1
