"""Partial aggregates per batch against the same aggregates over the events."""

import pytest
from pyspark.sql import functions as F

from ordwave.config import IngestConfig
from ordwave.plans import reports
from ordwave.schemas import ORDERS_TOPIC
from ordwave.sources.fixtures import publish_topics
from ordwave.sources.kafka import record_files
from ordwave.streaming import partials
from ordwave.streaming.sinks import read_landed, read_quarantine
from ordwave.streaming.streams import drain, orders_lander, run_streams


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def landed(spark, sf_small, tmp_path_factory):
    base = tmp_path_factory.mktemp("partials")
    topics = publish_topics(spark, sf_small)
    cfg = IngestConfig(sink_root=f"{base}/landed", checkpoint_root=f"{base}/ck", max_files_per_trigger=2)
    drain(run_streams(spark, "orders", cfg, topic_paths={ORDERS_TOPIC: f"{topics}/{ORDERS_TOPIC}"}, available_now=True))
    return cfg.sink_root


def check(spark, sf_small, root):
    parts = partials.read_partials(spark, root, "orders")
    assert rows(partials.stored_rows_per_day(parts)) == rows(reports.rows_per_day(read_landed(spark, root, "orders")))
    log = record_files(spark, f"{publish_topics(spark, sf_small)}/{ORDERS_TOPIC}")
    assert rows(partials.stored_offset_gaps(parts)) == rows(reports.offset_gaps(log))
    want = reports.table_report(spark, {"orders": (read_landed(spark, root, "orders"), "timestamp"),
                                        "orders_quarantine": (read_quarantine(spark, root, "orders"), "kafka_timestamp"),
                                        "pricing_events": (None, "timestamp"), "pricing_events_quarantine": (None, "timestamp")})
    assert rows(partials.stored_summary(spark, root, ["orders", "pricing_events"])) == rows(want)


def test_reports_from_partials(spark, sf_small, landed):
    check(spark, sf_small, landed)


def test_folds_change_nothing_and_events_are_not_read(spark, sf_small, landed):
    last = partials._layout(spark, landed, "orders")[2][-1]
    assert partials.fold_partials(spark, landed, "orders", 1)
    check(spark, sf_small, landed)
    assert partials.fold_partials(spark, landed, "orders", int(last[2:]) - 1)
    through, older, batches = partials._layout(spark, landed, "orders")
    assert through == int(last[2:]) - 1 and older == [1] and batches[0] == "s-000000000002"        # 0 and 1 are deleted
    assert not partials.fold_partials(spark, landed, "orders", through)
    check(spark, sf_small, landed)
    files = partials.stored_rows_per_day(partials.read_partials(spark, landed, "orders")).inputFiles()
    assert files and all("/partials/" in f for f in files)


def test_a_replayed_batch_is_counted_once(spark, sf_small, tmp_path):
    log = record_files(spark, f"{publish_topics(spark, sf_small)}/{ORDERS_TOPIC}")
    lander = orders_lander(str(tmp_path))
    lander(log.where("offset % 2 = 0"), 0)
    lander(log.where("offset % 2 = 1"), 1)
    lander(log.where("offset % 2 = 1"), 1)
    check(spark, sf_small, str(tmp_path))


def test_full_bitmaps_are_dropped_and_gaps_found(spark):
    def of(offsets):
        return partials.of_batch(offsets.select(
            F.lit("good").alias("status"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("timestamp"), F.lit(None).cast("timestamp").alias("kafka_timestamp"),
            F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset")))

    ids = spark.range(1, 4 * partials.BITMAP + 1)
    lost = ids.where("id NOT IN (7, 8, 70000)")
    parts = of(lost.where("id % 3 = 0")).unionByName(of(lost.where("id % 3 > 0")))
    merged = partials.merge(parts).where("kind = 'offsets'").orderBy("bucket").collect()
    assert [r.full for r in merged] == [False, True, False, True]
    assert [r.bits is None for r in merged] == [False, True, False, True]
    assert rows(partials.stored_offset_gaps(partials.merge(parts))) == [("t", 0, 1, 4 * partials.BITMAP, 4 * partials.BITMAP - 3, 4 * partials.BITMAP - 3, 3)]
    twice = partials.merge(parts).unionByName(of(ids.where("id = 5")))
    got = partials.stored_offset_gaps(twice).first()
    assert (got.n, got.n_distinct, got.missing) == (4 * partials.BITMAP - 2, 4 * partials.BITMAP - 3, 3)


def test_nothing_landed(spark, tmp_path):
    parts = partials.read_partials(spark, str(tmp_path), "orders")
    assert partials.stored_rows_per_day(parts).count() == 0 and partials.stored_offset_gaps(parts).count() == 0
    assert {r.status for r in partials.stored_summary(spark, str(tmp_path), ["orders"]).collect()} == {"missing"}


def test_records_at_written_coordinates(spark, tmp_path):
    log = spark.range(100_000).selectExpr("'t' AS topic", "CAST(id % 3 AS INT) AS partition", "id DIV 3 AS offset", "CAST('v' AS BINARY) AS value")
    some = log.where("offset % 7 = 0 OR offset > 32000")
    partials.write_coordinates(some, f"{tmp_path}/at")
    got = partials.records_at(log, f"{tmp_path}/at")
    assert got.columns == log.columns and got.count() == some.count() and got.exceptAll(some).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
