"""Running the streams: stopping between batches, failures on record, progress kept."""

import time

import pytest
from pyspark.sql import functions as F

from ordwave.cli import main
from ordwave.config import IngestConfig
from ordwave.operators.transform import landed_orders, orders_flagged
from ordwave.plans.reports import audit_totals, latest_audit
from ordwave.schemas import ORDERS_TOPIC
from ordwave.sources.fixtures import publish_topics
from ordwave.sources.kafka import record_files, record_files_stream
from ordwave.streaming.sinks import BatchLander, failing_record, read_audit, read_landed
from ordwave.streaming.streams import ProgressTable, await_all, drain, orders_lander, read_progress, run_streams, start_ingest


@pytest.fixture(scope="module")
def log(spark, sf_small):
    return f"{publish_topics(spark, sf_small)}/{ORDERS_TOPIC}"


def test_a_stop_marker_ends_the_stream_between_batches(spark, log, tmp_path):
    marker = str(tmp_path / "STOP")
    cfg = IngestConfig(sink_root=f"{tmp_path}/landed", checkpoint_root=f"{tmp_path}/ck", max_files_per_trigger=1, stop_marker=marker)
    calls, lander = [], orders_lander(cfg.sink_root)
    after = lander.after

    def ask(session, batch_id):                            # asked for while batch 1 is running
        after(session, batch_id)
        calls.append(batch_id)
        if batch_id == 1:
            assert main(["stop", "--stop-marker", marker], spark) == 0

    lander.after = ask
    q = start_ingest(record_files_stream(spark, log, 1), lander, f"{tmp_path}/ck/orders", cfg, available_now=True)
    await_all(spark, [q], stop_marker=marker)
    assert not q.isActive and calls == [0, 1]
    audit = latest_audit(read_audit(spark, cfg.sink_root)).collect()
    assert {(r.batch_id, r.status) for r in audit} == {(0, "ok"), (1, "ok")}             # batch 1 is complete
    assert main(["ingest", "--mode", "orders", "--stop-marker", marker, "--sink-root", cfg.sink_root, "--checkpoint-root", str(tmp_path / "ck")], spark) == 1
    assert main(["stop", "--stop-marker", marker, "--clear"], spark) == 0
    drain(run_streams(spark, "orders", cfg, topic_paths={ORDERS_TOPIC: log}, available_now=True))
    want = landed_orders(orders_flagged(record_files(spark, log)).where("NOT has_quality_issues"))
    assert sorted(map(tuple, read_landed(spark, cfg.sink_root, "orders").collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_an_idle_stream_is_stopped(spark, log, tmp_path):
    marker = str(tmp_path / "STOP")
    cfg = IngestConfig(sink_root=f"{tmp_path}/landed", checkpoint_root=f"{tmp_path}/ck", trigger_seconds=1, stop_marker=marker)
    (q,) = run_streams(spark, "orders", cfg, topic_paths={ORDERS_TOPIC: log})
    q.processAllAvailable()
    main(["stop", "--stop-marker", marker], spark)
    await_all(spark, [q], stop_marker=marker)
    assert not q.isActive
    assert {r.status for r in read_audit(spark, cfg.sink_root).collect()} == {"ok"}


def test_the_failing_record_is_on_record(spark, log, tmp_path):
    """One record of the batch makes the write fail: the audit names it; once
    the writer is mended the batch completes and the failure stays on record."""
    first = record_files(spark, log).where("value IS NOT NULL").agg(F.max(F.struct("partition", "offset")).alias("x")).first().x
    culprit = (F.col("partition") == first.partition) & (F.col("offset") == first.offset)

    def shape(df, extra=()):
        return landed_orders(df.withColumn("quantity", F.when(culprit, F.raise_error(F.lit("cannot store"))).otherwise(F.col("quantity")).cast("int")), extra)

    root = str(tmp_path / "landed")
    lander = BatchLander("orders", root, orders_flagged, shape, "orders")
    q = start_ingest(record_files_stream(spark, log, 100), lander, f"{tmp_path}/ck", IngestConfig(), available_now=True)
    with pytest.raises(Exception, match="cannot store"):
        drain([q])
    (row,) = read_audit(spark, root).collect()
    assert row.status == "failed" and row.sample.startswith(f"{ORDERS_TOPIC}[{first.partition}]@{first.offset}: ")
    drain([start_ingest(record_files_stream(spark, log, 100), orders_lander(root), f"{tmp_path}/ck", IngestConfig(), available_now=True)])
    t = audit_totals(read_audit(spark, root)).first()
    assert t.failed_attempts == 1 and t.sample == row.sample and t.n_in == record_files(spark, log).count()


def test_no_record_is_blamed_for_the_sink(spark, log):
    records = record_files(spark, log).limit(20)
    assert failing_record(records, lambda df: df) is None


def test_progress_is_kept_beyond_what_spark_remembers(spark, log, tmp_path):
    table = ProgressTable(spark, str(tmp_path / "progress"), every=3)
    spark.streams.addListener(table)
    try:
        cfg = IngestConfig(sink_root=f"{tmp_path}/landed", checkpoint_root=f"{tmp_path}/ck", max_files_per_trigger=2)
        drain(run_streams(spark, "orders", cfg, topic_paths={ORDERS_TOPIC: log}, available_now=True))
        want = read_audit(spark, cfg.sink_root).count()
        for _ in range(100):                                # reports arrive asynchronously
            table.flush()
            got = read_progress(spark, table.path).where("rows > 0") if (tmp_path / "progress").exists() else None
            if got is not None and got.count() >= want:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(table)
    assert got.count() == want > 2 and got.agg(F.sum("rows")).first()[0] == record_files(spark, log).count()
    assert got.where("duration_ms > 0 AND dropped_late = 0").count() == want


def test_tombstones_are_dropped_in_every_path(spark, log, sf_small, tmp_path):
    cfg = IngestConfig(sink_root=f"{tmp_path}/landed", checkpoint_root=f"{tmp_path}/ck", drop_tombstones=True)
    drain(run_streams(spark, "orders", cfg, topic_paths={ORDERS_TOPIC: log}, available_now=True))
    present = record_files(spark, log).where("value IS NOT NULL").count()
    assert read_audit(spark, cfg.sink_root).agg(F.sum("n_in")).first()[0] == present < record_files(spark, log).count()
    root = log.rsplit("/", 1)[0]
    assert main(["backfill", "--topics-dir", root, "--sink-root", f"{tmp_path}/load", "--drop-tombstones"], spark) == 0
    from ordwave.streaming.sinks import read_quarantine
    assert read_quarantine(spark, f"{tmp_path}/load", "orders").where("value IS NULL").count() == 0
