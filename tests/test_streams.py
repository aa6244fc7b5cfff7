"""Stream semantics with availableNow over the file form of the topics."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from ordwave.config import IngestConfig
from ordwave.operators.transform import landed_orders, orders_flagged
from ordwave.operators.validate import bad_rows, good_rows
from ordwave.plans import landing
from ordwave.schemas import ORDERS_TOPIC
from ordwave.sources.fixtures import publish_topics
from ordwave.sources.tables import hadoop_fs
from ordwave.sources.kafka import record_files
from ordwave.plans.reports import audit_totals, latest_audit
from ordwave.streaming.sinks import BatchLander, OwnershipError, read_audit, read_landed, read_quarantine
from ordwave.streaming.streams import drain, orders_lander, run_streams, start_ingest
from ordwave.sources.kafka import record_files_stream


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def topics(spark, sf_small):
    return publish_topics(spark, sf_small)


def _land(spark, sf_small, base, files_per_trigger=2):
    cfg = IngestConfig(sink_root=f"{base}/landed", checkpoint_root=f"{base}/ckpt",
                         max_files_per_trigger=files_per_trigger)
    root = publish_topics(spark, sf_small)
    drain(run_streams(spark, "orders", cfg, topic_paths={ORDERS_TOPIC: f"{root}/{ORDERS_TOPIC}"},
                      available_now=True))
    return cfg


def test_stream_equals_batch_and_good_plus_bad_is_input(spark, sf_small, topics, tmp_path):
    cfg = _land(spark, sf_small, str(tmp_path))
    landed = read_landed(spark, cfg.sink_root, "orders")
    quarantine = read_quarantine(spark, cfg.sink_root, "orders")
    recs = record_files(spark, f"{topics}/{ORDERS_TOPIC}")
    batch = landed_orders(good_rows(orders_flagged(recs)))
    assert _rows(landed) == _rows(batch)
    assert landed.count() + quarantine.count() == recs.count()
    assert quarantine.count() == bad_rows(orders_flagged(recs)).count()
    audit = spark.read.parquet(f"{cfg.sink_root}/audit")
    assert audit.select("batch_id").distinct().count() > 1          # several micro-batches
    assert {r.status for r in audit.collect()} == {"ok"}


def test_multi_batch_equals_single_batch(spark, sf_small, tmp_path):
    a = _land(spark, sf_small, str(tmp_path / "a"), files_per_trigger=1)
    b = _land(spark, sf_small, str(tmp_path / "b"), files_per_trigger=None)
    ra = read_landed(spark, a.sink_root, "orders")
    rb = read_landed(spark, b.sink_root, "orders")
    assert _rows(ra) == _rows(rb)


def test_micro_batches_bounded_by_bytes(spark, sf_small, topics, tmp_path):
    sizes = [os.path.getsize(f) for f in glob.glob(f"{topics}/{ORDERS_TOPIC}/part-*.parquet".replace("file:", ""))]
    cfg = IngestConfig(sink_root=f"{tmp_path}/landed", checkpoint_root=f"{tmp_path}/ckpt", max_files_per_trigger=1, max_bytes_per_trigger=sum(sizes) // 2)
    drain(run_streams(spark, "orders", cfg, topic_paths={ORDERS_TOPIC: f"{topics}/{ORDERS_TOPIC}"}, available_now=True))
    assert 1 < read_audit(spark, cfg.sink_root).count() < len(sizes)
    assert read_audit(spark, cfg.sink_root).agg(F.sum("n_in")).first()[0] == record_files(spark, f"{topics}/{ORDERS_TOPIC}").count()


def test_restart_adds_nothing_and_replay_overwrites(spark, sf_small, tmp_path):
    base = str(tmp_path)
    cfg = _land(spark, sf_small, base)
    n0 = read_landed(spark, cfg.sink_root, "orders").count()
    _land(spark, sf_small, base)                                   # restart, no new data
    assert read_landed(spark, cfg.sink_root, "orders").count() == n0
    # simulate a crash after the write but before the commit: drop the last
    # commit entry; the restart replays that batch, which overwrites itself
    commits = sorted(glob.glob(f"{cfg.checkpoint_root}/orders/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    last = commits[-1]
    os.remove(last)
    crc = os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    _land(spark, sf_small, base)
    assert read_landed(spark, cfg.sink_root, "orders").count() == n0


def test_failing_writer_leaves_batch_uncommitted(spark, sf_small, topics, tmp_path):
    base = str(tmp_path)
    ckpt = f"{base}/ckpt"

    def broken_shape(df, extra=()):
        return df.select(F.raise_error(F.lit("sink down")).alias("x"), *extra)

    lander = BatchLander("orders", f"{base}/landed", orders_flagged, broken_shape, "orders")
    src = record_files_stream(spark, f"{topics}/{ORDERS_TOPIC}", 100)
    q = start_ingest(src, lander, ckpt, IngestConfig(), available_now=True)
    with pytest.raises(Exception):
        drain([q])
    audit = spark.read.parquet(f"{base}/landed/audit").collect()
    assert [r.status for r in audit] == ["failed"]
    assert not glob.glob(f"{ckpt}/commits/0")
    # the repaired writer picks up the same batch and completes it
    q2 = start_ingest(record_files_stream(spark, f"{topics}/{ORDERS_TOPIC}", 100),
                      orders_lander(f"{base}/landed"), ckpt, IngestConfig(), available_now=True)
    drain([q2])
    # the failure stays on record; the latest attempt is the good one
    audit = read_audit(spark, f"{base}/landed")
    assert sorted(r.status for r in audit.collect()) == ["failed", "ok"]
    assert [r.status for r in latest_audit(audit).collect()] == ["ok"]
    t = audit_totals(audit).first()
    assert t.failed_attempts == 1 and t.failed_batch == 0 and "sink down" in t.error and t.batches == 1


def test_output_root_refuses_a_second_checkpoint(spark, sf_small, topics, tmp_path):
    base = str(tmp_path)
    src = record_files_stream(spark, f"{topics}/{ORDERS_TOPIC}", 100)
    drain([start_ingest(src, orders_lander(f"{base}/landed"), f"{base}/c1", IngestConfig(), True)])
    with pytest.raises(OwnershipError):
        start_ingest(src, orders_lander(f"{base}/landed"), f"{base}/c2", IngestConfig(), True)


def test_stream_dedup_within_watermark(spark, tmp_path):
    """G1 stream: replays close in broker time are dropped, keeping one row
    per key (events are time-ordered; every 4th event is sent twice)."""
    from ordwave.streaming.streams import dedup_stream
    src_dir = str(tmp_path / "src")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    dup = ev.unionByName(ev.where(F.col("event_id") % 4 == 0))
    (dup.select(F.col("event_id").cast("string").alias("order_id"), F.col("ts").cast("timestamp").alias("kafka_timestamp"))
     .repartition(4).write.parquet(src_dir))
    stream = spark.readStream.schema("order_id string, kafka_timestamp timestamp").parquet(src_dir)
    out = str(tmp_path / "out")
    q = (dedup_stream(stream, delay="1 hour").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == got.select("order_id").distinct().count() == ev.count()


def test_shared_landing_is_reused(spark, sf_small):
    a = landing.shared_landing(spark, sf_small)
    assert landing.shared_landing(spark, sf_small) == a


def test_optional_pricing_quarantine(spark, sf_small, topics, tmp_path):
    """Pricing is not validated by default; with ``quarantine_pricing``
    unparseable records (every field NULL) go to quarantine."""
    cfg = IngestConfig(sink_root=f"{tmp_path}/landed", checkpoint_root=f"{tmp_path}/ck", quarantine_pricing=True)
    from ordwave.schemas import PRICING_TOPIC
    drain(run_streams(spark, "pricing", cfg, topic_paths={PRICING_TOPIC: f"{topics}/{PRICING_TOPIC}"},
                      available_now=True))
    from ordwave.operators.transform import pricing_flagged
    parsed = pricing_flagged(record_files(spark, f"{topics}/{PRICING_TOPIC}"))
    unparseable = parsed.where(F.col("product_id").isNull() & F.col("timestamp_text").isNull()).count()
    q = read_quarantine(spark, cfg.sink_root, "pricing_events")
    assert q.count() == unparseable > 0
    assert read_landed(spark, cfg.sink_root, "pricing_events").count() + q.count() == parsed.count()


def test_output_shapes_match_the_declared_schemas(spark, sf_small, tmp_path):
    from ordwave.schemas import BATCH_AUDIT, QUARANTINE
    cfg = _land(spark, sf_small, str(tmp_path))
    q = read_quarantine(spark, cfg.sink_root, "orders")
    assert [(f.name, f.dataType) for f in q.schema.fields] == [(f.name, f.dataType) for f in QUARANTINE.fields]
    audit = spark.read.parquet(f"{cfg.sink_root}/audit")
    assert sorted(audit.columns) == sorted(f.name for f in BATCH_AUDIT.fields)


def drop_last_commit(spark, checkpoint):
    """Remove the newest entry of a query's commit log, the state a crash
    between a batch's writes and its commit leaves behind; the next start
    replays that batch. Returns the batch id, or None if nothing was
    committed."""
    fs = hadoop_fs(spark, f"{checkpoint}/commits")
    if fs is None or not fs[0].exists(fs[1]):
        return None
    names = [st.getPath().getName() for st in fs[0].listStatus(fs[1])]
    ids = sorted(int(n) for n in names if n.isdigit())
    if not ids:
        return None
    last = ids[-1]
    for name in (str(last), f".{last}.crc"):
        target = hadoop_fs(spark, f"{checkpoint}/commits/{name}")
        if target[0].exists(target[1]):
            target[0].delete(target[1], False)
    return last


def test_drop_last_commit_replays_one_batch(spark, sf_small, tmp_path):
    base = str(tmp_path)
    cfg = _land(spark, sf_small, base)
    n0 = read_landed(spark, cfg.sink_root, "orders").count()
    last = drop_last_commit(spark, f"{cfg.checkpoint_root}/orders")
    assert last is not None and not os.path.exists(f"{cfg.checkpoint_root}/orders/commits/{last}")
    _land(spark, sf_small, base)
    assert os.path.exists(f"{cfg.checkpoint_root}/orders/commits/{last}")     # the batch ran again
    assert read_landed(spark, cfg.sink_root, "orders").count() == n0


@pytest.mark.parametrize("batches", [2, 4, 8])
def test_stream_dedup_is_the_same_for_any_batches(spark, sf_small, topics, batches):
    """The log spans more broker time than the delay; no order is lost to the
    watermark, and orders without an id are kept."""
    import __spark_entry__ as E
    from ordwave.plans.registry import run_stream_dedup
    recs = record_files(spark, f"{topics}/{ORDERS_TOPIC}")
    span = recs.agg(F.max("timestamp").cast("double") - F.min("timestamp").cast("double")).first()[0]
    files = len(glob.glob(f"{topics}/{ORDERS_TOPIC}/part-*.parquet".replace("file:", "")))
    got = run_stream_dedup(spark, sf_small, max(1, files // batches), f"{max(1, int(span * 1000 / 3))} milliseconds")
    want = E.queries()["orders_dedup"](spark, sf_small).select("order_id")
    assert _rows(got) == _rows(want)
    assert got.where("order_id = ''").count() > 1


def test_rows_later_than_the_watermark_are_an_error(spark, tmp_path):
    from ordwave.streaming.streams import LateRowsError, dedup_stream, require_no_late_rows
    src = str(tmp_path / "src")
    rows = [[("a", 1000), ("b", 2000)], [("c", 3000)], [("late", 10)]]
    for k, part in enumerate(rows):
        (spark.createDataFrame(part, "k string, s long").select("k", F.timestamp_seconds("s").alias("kafka_timestamp"))
         .coalesce(1).write.mode("append").parquet(src))
        for f in glob.glob(f"{src}/part-*"):
            if os.path.getmtime(f) > 2000:
                fs, p = hadoop_fs(spark, f)
                fs.setTimes(p, 1000 * (k + 1), -1)
    stream = spark.readStream.schema("k string, kafka_timestamp timestamp").option("maxFilesPerTrigger", 1).parquet(src)
    q = (dedup_stream(stream, "k", delay="1 minute").writeStream.format("parquet").option("path", str(tmp_path / "o"))
         .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    q.awaitTermination()
    with pytest.raises(LateRowsError):
        require_no_late_rows(q)


def test_quarantine_keeps_the_record(spark, sf_small, topics, tmp_path):
    cfg = _land(spark, sf_small, str(tmp_path))
    q = read_quarantine(spark, cfg.sink_root, "orders").select("topic", "partition", "offset", "key", "value")
    recs = record_files(spark, f"{topics}/{ORDERS_TOPIC}").select("topic", "partition", "offset", "key", "value")
    assert q.exceptAll(recs).count() == 0 and q.where("value is not null").count() > 0
