"""Plan properties that matter at scale, checked on explain() output."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from ordwave.operators import dims
from ordwave.plans import registry

STREAMING = {"stream_orders_landed", "stream_pricing_landed", "stream_multi_topic", "stream_replay_idempotent",
             "stream_rows_per_day", "stream_dedup", "load_reconciliation", "orders_compacted", "orders_unique", "offset_gaps_stored",
             "orders_enriched_landed"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark, sf_small):
    return {name: plan_of(fn(spark, sf_small)) for name, fn in registry.QUERIES.items() if name not in STREAMING}


def test_no_cross_joins_or_python_evaluation(plans):
    bad = {name: [f for f in FORBIDDEN if f in p] for name, p in plans.items()}
    assert {k: v for k, v in bad.items() if v} == {}


def test_first_n_are_found_with_a_heap(plans):
    assert plans["preview_first_n"].count("TakeOrderedAndProject") == 2


def test_dedup_limits_hot_keys_before_the_shuffle(plans):
    assert "WindowGroupLimit" in plans["orders_dedup"] and "Partial" in plans["orders_dedup"]


@pytest.mark.parametrize("lookup,key", [(lambda s, d, o: dims.return_rate(o, dims.brand_return_dim(s, d)), "brand"),
                                        (lambda s, d, o: dims.with_discount_profile(o, dims.discount_profile_dim(s, d)), "category")])
def test_small_dimensions_do_not_shuffle_the_fact(spark, sf_small, lookup, key):
    """As at scale, where ``part`` is above the broadcast threshold."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        plan = plan_of(lookup(spark, sf_small, spark.range(10**6).select(F.col("id").cast("string").alias(key))))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and f"hashpartitioning({key}" not in plan


def test_landed_reads_prune_on_status(plans):
    assert "PartitionFilters: [isnotnull(status" in plans["rows_per_day_head_tail"]


def test_parse_is_not_under_the_filter(plans):
    p = plans["orders_strict"]
    assert "Generate inline" in p
    filter_line = next(line for line in p.splitlines() if "Filter" in line)
    assert "from_json" not in filter_line


def test_mix_audit_scans_orders_once(plans):
    # the grouping-sets aggregate is checkpointed; the final plan reads it
    assert plans["mix_audit"].count("Expand") == 0
