"""Stream lifecycle and sink shapes: empty batches, awaiting several
queries, progress listener, running totals, compaction, Kafka record shape."""

import glob

from pyspark.sql import functions as F

from ordwave.config import IngestConfig, build_session
from ordwave.operators.transform import landed_orders, orders_flagged
from ordwave.operators.validate import good_rows
from ordwave.plans import landing, reports
from ordwave.schemas import KAFKA_RECORD, ORDER_FIELDS, ORDERS, ORDERS_TOPIC, PRICING_TOPIC
from ordwave.sources.fixtures import publish_topics
from ordwave.sources.kafka import record_files
from ordwave.sources.snapshots import list_batches
from ordwave.streaming.sinks import kafka_records_for, read_landed
from ordwave.streaming.streams import attach_progress, await_all, orders_lander, run_streams


def test_empty_batch_writes_only_an_audit_row(spark, tmp_path):
    lander = orders_lander(str(tmp_path))
    lander(spark.createDataFrame([], KAFKA_RECORD), 0)
    audit = spark.read.parquet(f"{tmp_path}/audit").collect()
    assert [(r.status, r.n_in) for r in audit] == [("empty", 0)]
    assert not glob.glob(f"{tmp_path}/orders/batch=*/status=*")


def test_await_all_runs_both_streams_and_progress_is_recorded(spark, sf_small, tmp_path):
    rec = attach_progress(spark)
    root = publish_topics(spark, sf_small)
    cfg = IngestConfig(sink_root=f"{tmp_path}/landed", checkpoint_root=f"{tmp_path}/ck", max_files_per_trigger=4)
    qs = run_streams(spark, "both", cfg, available_now=True,
                     topic_paths={ORDERS_TOPIC: f"{root}/{ORDERS_TOPIC}", PRICING_TOPIC: f"{root}/{PRICING_TOPIC}"})
    await_all(spark, qs)
    assert not any(q.isActive for q in qs)
    assert read_landed(spark, f"{tmp_path}/landed", "orders").count() > 0
    assert read_landed(spark, f"{tmp_path}/landed", "pricing_events").count() > 0
    import time
    for _ in range(50):                      # listener events arrive asynchronously
        if rec.progress:
            break
        time.sleep(0.1)
    assert rec.progress and all("rows" in p for p in rec.progress)
    spark.streams.removeListener(rec)
    totals = reports.running_totals(reports.latest_audit(spark.read.parquet(f"{tmp_path}/landed/audit")))
    last = totals.where(F.col("query") == "orders").orderBy(F.col("batch_id").desc()).first()
    audit = spark.read.parquet(f"{tmp_path}/landed/audit").where("query = 'orders'")
    assert last.cum_in == audit.agg(F.sum("n_in")).first()[0]


def test_kafka_record_shape_round_trips(spark, sf_small):
    root = publish_topics(spark, sf_small)
    good = landed_orders(good_rows(orders_flagged(record_files(spark, f"{root}/{ORDERS_TOPIC}"))))
    out = kafka_records_for(good.drop("event_date"), ORDER_FIELDS)
    assert out.columns == ["key", "value"]
    back = out.select(F.from_json(F.col("value").cast("string"), ORDERS).alias("j")).select("j.*")
    assert back.where(F.col("order_id").isNull() | F.col("timestamp").isNull()).count() == 0
    assert back.count() == good.count()


def test_build_session_sets_utc(spark):
    s = build_session(master="local[4]")
    assert s.conf.get("spark.sql.session.timeZone") == "UTC"


def test_console_preview_runs(spark, sf_small):
    from ordwave.streaming.sinks import console_preview
    from ordwave.sources.kafka import record_files_stream
    root = publish_topics(spark, sf_small)
    q = console_preview(record_files_stream(spark, f"{root}/{ORDERS_TOPIC}", 100).select("topic", "offset"), 3)
    q.processAllAvailable()
    q.stop()
    assert q.exception() is None


def test_processing_time_trigger(spark, sf_small, tmp_path):
    """The live form uses a processing-time trigger; here 1 s over the
    file form, drained with processAllAvailable and stopped (T7)."""
    root = publish_topics(spark, sf_small)
    cfg = IngestConfig(sink_root=f"{tmp_path}/landed", checkpoint_root=f"{tmp_path}/ck", trigger_seconds=1)
    (q,) = run_streams(spark, "orders", cfg, topic_paths={ORDERS_TOPIC: f"{root}/{ORDERS_TOPIC}"})
    q.processAllAvailable()
    q.stop()
    assert q.lastProgress is not None
    assert read_landed(spark, cfg.sink_root, "orders").count() > 0


def test_booleans_are_coerced_or_quarantined(spark):
    from ordwave.functions.parse import coerce_booleans
    from ordwave.operators.transform import pricing_flagged
    values = ["true", "false", '"true"', '"No"', "1", "0", '" yes "', "null", '"maybe"', "7", "[1]", '{"a": 1}']
    want = [True, False, True, False, True, False, True, None, None, None, None, None]
    rows = [(bytearray(f'{{"order_id": "o{i}", "product_id": "p", "timestamp": "2024-01-01T00:00:00", "is_returned": {v}}}', "utf8"), "t", 0, i)
            for i, v in enumerate(values)]
    rows += [(bytearray(b'{"order_id": "x", "is_ret'), "t", 0, 98), (None, "t", 0, 99)]
    df = spark.createDataFrame(rows, "value binary, topic string, partition int, offset long").selectExpr(
        "CAST(NULL AS BINARY) AS key", "value", "topic", "partition", "offset", "CAST(NULL AS TIMESTAMP) AS timestamp", "0 AS timestampType")
    got = coerce_booleans(orders_flagged(df)).orderBy("offset").collect()
    assert [r.is_returned for r in got] == [*want, None, None]
    bad = ["is_returned_not_boolean" in r.quality_reasons for r in got]
    assert bad == [v in ('"maybe"', "7", "[1]", '{"a": 1}') for v in values] + [False, False]
    assert all(r.has_quality_issues for r, b in zip(got, bad) if b)
    assert "is_returned" not in coerce_booleans(pricing_flagged(df)).columns


def test_stream_and_backfill_share_one_table(spark, sf_small, tmp_path):
    """A backfill (S9) lands next to the stream's micro-batches in the same
    table; each is idempotent in its own batch directory."""
    from ordwave.streaming.sinks import write_batch_load
    from ordwave.operators.transform import landed_orders, orders_flagged
    root = publish_topics(spark, sf_small)
    cfg = IngestConfig(sink_root=f"{tmp_path}/landed", checkpoint_root=f"{tmp_path}/ck", max_files_per_trigger=4)
    await_all(spark, run_streams(spark, "orders", cfg, topic_paths={ORDERS_TOPIC: f"{root}/{ORDERS_TOPIC}"},
                                 available_now=True))
    n_stream = read_landed(spark, cfg.sink_root, "orders").count()
    recs = record_files(spark, f"{root}/{ORDERS_TOPIC}")
    for _ in range(2):                       # the same load twice lands once
        write_batch_load(orders_flagged(recs), landed_orders, cfg.sink_root, "orders", "L1")
    both = read_landed(spark, cfg.sink_root, "orders", with_batch=True)
    assert both.count() == 2 * n_stream
    assert both.where(F.col("batch").startswith("l-")).count() == n_stream


def test_stateful_queries_record_rocksdb_and_restore_the_session(spark, sf_small, tmp_path):
    from ordwave.operators.validate import good_rows
    from ordwave.sources.kafka import record_files_stream
    from ordwave.streaming.streams import read_daily_counts, start_daily_counts
    before = spark.conf.get("spark.sql.shuffle.partitions")
    root = publish_topics(spark, sf_small)
    good = landed_orders(good_rows(orders_flagged(record_files_stream(spark, f"{root}/{ORDERS_TOPIC}", 100))))
    q = start_daily_counts(good, str(tmp_path / "daily"), str(tmp_path / "ck"), IngestConfig(), available_now=True)
    q.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    offsets = open(glob.glob(str(tmp_path / "ck" / "offsets" / "0"))[0]).read()
    assert "RocksDBStateStoreProvider" in offsets
    assert read_daily_counts(spark, str(tmp_path / "daily")).agg(F.sum("n")).first()[0] == good_count(spark, root)


def good_count(spark, root):
    return landed_orders(good_rows(orders_flagged(record_files(spark, f"{root}/{ORDERS_TOPIC}")))).count()


def test_compacted_history_plus_newer_batches(spark, sf_small, tmp_path):
    """Compaction folds the stream batches into history; rows landed
    after it are read from their own batch directories only."""
    root = publish_topics(spark, sf_small)
    files = sorted(glob.glob(f"{root}/{ORDERS_TOPIC}/*.parquet".replace("file:", "")))
    half = tmp_path / "topic"
    half.mkdir()
    import os
    import shutil
    for f in files[: len(files) // 2]:
        shutil.copy(f, half / os.path.basename(f))
    cfg = IngestConfig(sink_root=f"{tmp_path}/landed", checkpoint_root=f"{tmp_path}/ck", max_files_per_trigger=2)
    await_all(spark, run_streams(spark, "orders", cfg, topic_paths={ORDERS_TOPIC: str(half)}, available_now=True))
    folded = landing.compact_landed(spark, cfg.sink_root, "orders", files=2)
    assert folded
    for f in files[len(files) // 2:]:                   # more data arrives after the compaction
        shutil.copy(f, half / os.path.basename(f))
    await_all(spark, run_streams(spark, "orders", cfg, topic_paths={ORDERS_TOPIC: str(half)}, available_now=True))
    from ordwave.streaming.sinks import write_batch_load
    write_batch_load(orders_flagged(record_files(spark, files[:1])), landed_orders, cfg.sink_root, "orders", "L9")
    assert [b for b in list_batches(spark, cfg.sink_root, "orders") if b > folded[-1]]           # newer batches exist
    current = read_landed(spark, cfg.sink_root, "orders")
    recs = record_files(spark, files)
    want = landed_orders(good_rows(orders_flagged(recs))).unionAll(landed_orders(good_rows(orders_flagged(record_files(spark, files[:1])))))
    assert sorted(map(tuple, current.collect())) == sorted(map(tuple, want.collect()))
