"""Streaming queries and their lifecycle (T1-T8, G1, G3, S9 in stream form).

One StreamingQuery per selected stream, each with its own checkpoint; all
run in one session and are awaited together, so a failure of any stream
is seen at once (R14).
"""

from __future__ import annotations

import uuid
from collections import deque
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..config import IngestConfig, work_root
from ..operators.dedup import has_key
from ..operators.transform import landed_orders, landed_pricing, orders_flagged, pricing_flagged
from ..schemas import ORDER_FIELDS
from ..sources.kafka import kafka_stream, record_files_stream, route
from ..sources.tables import path_exists
from .sinks import BatchLander, RoutingLander, StopRequested, UniqueLander, claim_output


def _trigger(writer, cfg: IngestConfig, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{cfg.trigger_seconds} seconds")


def orders_lander(out_root: str, validator: str = "nulls") -> BatchLander:
    return BatchLander("orders", out_root, lambda b: orders_flagged(b, validator), landed_orders, "orders")


def unique_orders_lander(out_root: str, validator: str = "nulls") -> UniqueLander:
    """Orders, and the table of each order's first arrival (``orders_unique``)."""
    return UniqueLander("orders", out_root, lambda b: orders_flagged(b, validator), landed_orders, "orders", key=order_key(ORDER_FIELDS))


def pricing_lander(out_root: str, validator: str | None = None) -> BatchLander:
    return BatchLander("pricing", out_root, lambda b: pricing_flagged(b, validator), landed_pricing, "pricing_events")


def start_ingest(source: DataFrame, lander: BatchLander, checkpoint: str, cfg: IngestConfig,
                 available_now: bool = False) -> StreamingQuery:
    """Source -> foreachBatch(lander), append mode, checkpointed."""
    claim_output(source.sparkSession, lander.out_root, lander.name, checkpoint)
    lander.stop_marker = cfg.stop_marker
    w = (source.writeStream.foreachBatch(lander)
         .option("checkpointLocation", checkpoint)
         .outputMode("append")
         .queryName(f"{lander.name}_{uuid.uuid4().hex[:8]}"))
    return _trigger(w, cfg, available_now).start()


def run_streams(spark: SparkSession, mode: str = "both", cfg: IngestConfig | None = None,
                topic_paths: dict | None = None, available_now: bool = False) -> list:
    """Start the selected streams (``orders``, ``pricing`` or ``both``).
    Live Kafka by default; ``topic_paths`` (topic -> directory) switches to
    the file form of the topics."""
    cfg = cfg or IngestConfig()
    root = cfg.sink_root or f"{work_root(spark)}/landed"
    ckpt = cfg.checkpoint_root or f"{work_root(spark)}/checkpoints"
    wanted = {"orders": ["orders"], "pricing": ["pricing"], "both": ["orders", "pricing"]}[mode]
    out = []
    for name in wanted:
        topic = cfg.orders_topic if name == "orders" else cfg.pricing_topic
        if topic_paths:
            src = record_files_stream(spark, topic_paths[topic], cfg.max_files_per_trigger, cfg.max_bytes_per_trigger)
        else:
            src = route(kafka_stream(spark, cfg, topic), topic)
        if cfg.drop_tombstones:
            src = src.where(F.col("value").isNotNull())
        orders = unique_orders_lander if cfg.unique_orders else orders_lander
        lander = (orders(root, cfg.validator) if name == "orders"
                  else pricing_lander(root, "pricing" if cfg.quarantine_pricing else None))
        out.append(start_ingest(src, lander, f"{ckpt}/{name}", cfg, available_now))
    return out


def start_routed_ingest(source: DataFrame, cfg: IngestConfig, out_root: str, checkpoint: str,
                        available_now: bool = False, cache_raw: bool = True) -> StreamingQuery:
    """S5 + F4 as one query: one scan of all topics, routed per micro-batch
    to the orders and pricing landers (one checkpoint, one offset log).
    ``cache_raw`` keeps the raw batch for the second route (for Kafka; the
    file form re-reads cheaply, pruned by the topic column's statistics)."""
    orders = unique_orders_lander if cfg.unique_orders else orders_lander
    routes = {cfg.orders_topic: orders(out_root, cfg.validator),
              cfg.pricing_topic: pricing_lander(out_root, "pricing" if cfg.quarantine_pricing else None)}
    router = RoutingLander(routes, cache_raw=cache_raw, drop_tombstones=cfg.drop_tombstones)
    for lander in routes.values():
        claim_output(source.sparkSession, out_root, lander.name, checkpoint)
    router.stop_marker = cfg.stop_marker
    w = (source.writeStream.foreachBatch(router).option("checkpointLocation", checkpoint)
         .outputMode("append").queryName(f"routed_{uuid.uuid4().hex[:8]}"))
    return _trigger(w, cfg, available_now).start()


def _stopped_by_marker(q: StreamingQuery) -> bool:
    return q.exception() is not None and StopRequested.__name__ in str(q.exception())


def await_all(spark: SparkSession, queries: list, timeout_s: float | None = None, stop_marker: str | None = None) -> None:
    """Wait on all queries at once; on the first failure (or Ctrl+C) stop
    the rest and re-raise. With availableNow, returns when all have drained. With
    a stop marker, a query ends before its next micro-batch once the marker is
    there (the running one commits), and idle queries are stopped."""
    try:
        while any(q.isActive for q in queries):
            spark.streams.awaitAnyTermination(timeout_s or (2 if stop_marker else None))
            spark.streams.resetTerminated()
            for q in queries:
                if q.exception() is not None and not _stopped_by_marker(q):
                    raise q.exception()
            if stop_marker and path_exists(spark, stop_marker):
                for q in queries:
                    if q.isActive and not q.status["isTriggerActive"]:
                        q.stop()
            if timeout_s is not None:
                break
    except BaseException as e:
        for q in queries:
            if q.isActive and not (stop_marker and StopRequested.__name__ in str(e)):
                q.stop()
        if stop_marker and StopRequested.__name__ in str(e):         # awaitAnyTermination raises what ended a query
            spark.streams.resetTerminated()
            return await_all(spark, queries, timeout_s, stop_marker)
        raise


def drain(queries: list) -> None:
    """Bounded runs (availableNow): wait until all have finished; the first
    failure stops the rest at once and is raised. Only these queries are
    watched, so other streams of the session are left alone."""
    try:
        waiting = list(queries)
        while waiting:
            for q in list(waiting):
                if q.awaitTermination(0.2):          # raises the query's own failure
                    waiting.remove(q)
    except BaseException:
        for q in queries:
            if q.isActive:
                q.stop()
        raise


class LateRowsError(RuntimeError):
    pass


def require_no_late_rows(query: StreamingQuery) -> None:
    """Fail if the watermark made a stateful operator drop rows: a source
    whose partitions advance apart needs a longer delay."""
    late = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    if late:
        raise LateRowsError(f"{late} rows arrived after the watermark and were dropped")


class ProgressRecorder(StreamingQueryListener):
    """Keeps the last ``keep`` progress reports (rows, rates, durations)."""

    def __init__(self, keep: int = 1000):
        self.progress = deque(maxlen=keep)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.progress.append({"name": p.name, "batch_id": p.batchId, "rows": p.numInputRows,
                              "rows_per_s": p.processedRowsPerSecond,
                              "duration_ms": dict(p.durationMs or {})})

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


PROGRESS = "query string, run string, batch_id bigint, at string, rows bigint, rows_per_s double, duration_ms bigint, dropped_late bigint"


class ProgressTable(StreamingQueryListener):
    """Every progress report as a row of a table, appended in bulk (each
    ``every`` reports, when a query ends, and by :meth:`flush`). Rows dropped by
    a watermark are in it, whatever number of micro-batches Spark remembers."""

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self.rows: list = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.rows.append((p.name, str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.processedRowsPerSecond,
                          (p.durationMs or {}).get("triggerExecution", 0), sum(op.numRowsDroppedByWatermark for op in p.stateOperators)))
        if len(self.rows) >= self.every:
            self.flush()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.flush()

    def flush(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).parquet(path)


class ProgressPrinter(ProgressRecorder):
    """A5 + T8 on the console: one line per micro-batch and query."""

    def onQueryProgress(self, event):
        super().onQueryProgress(event)
        p = self.progress[-1]
        rate = p["rows_per_s"] or 0.0
        print(f"[{p['name']}] batch {p['batch_id']}: {p['rows']:,} rows | {rate:,.0f} rows/s | "
              f"{p['duration_ms'].get('triggerExecution', 0):,} ms", flush=True)


def attach_progress(spark: SparkSession, keep: int = 1000) -> ProgressRecorder:
    """Register a progress recorder on the session's stream manager."""
    rec = ProgressRecorder(keep)
    spark.streams.addListener(rec)
    return rec


# ---- guarantees ------------------------------------------------------------

def state_partitions(spark: SparkSession, cfg: IngestConfig | None = None) -> int:
    """State-store partitions of a stateful query. They are fixed when its
    checkpoint is created and adaptive execution cannot coalesce them, so
    they are sized to the cluster (its total cores) unless configured, not
    taken from a shuffle setting meant for batch joins."""
    if cfg is not None and cfg.state_partitions:
        return cfg.state_partitions
    try:
        return max(1, int(spark.sparkContext.defaultParallelism))
    except Exception:  # noqa: BLE001 - no classic context (Spark Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


STATE_PROVIDERS = {
    "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "hdfs": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
}


@contextmanager
def _stateful_session(spark: SparkSession, cfg: IngestConfig | None = None):
    """Start a stateful query with sized state partitions and the chosen
    state store (both are recorded in its checkpoint at the first start),
    leaving the session settings as they were."""
    cfg = cfg or IngestConfig()
    wanted = {"spark.sql.shuffle.partitions": str(state_partitions(spark, cfg)),
              "spark.sql.streaming.stateStore.providerClass": STATE_PROVIDERS[cfg.state_store]}
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def start_daily_counts(good_stream: DataFrame, out_path: str, checkpoint: str, cfg: IngestConfig,
                       available_now: bool = False) -> StreamingQuery:
    """Live rows-per-day. The state is one row per calendar day (bounded
    by the time span, not by the volume), so no watermark is needed and no
    late row is ever dropped. Each trigger writes the days that changed to a
    folder of its own (overwritten if the batch is replayed), so readers
    always find complete files; :func:`read_daily_counts` takes the latest
    count of each day."""
    counts = good_stream.groupBy(F.to_date("timestamp").alias("d")).agg(F.count(F.lit(1)).alias("n"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    w = (counts.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    with _stateful_session(good_stream.sparkSession, cfg):
        return _trigger(w, cfg, available_now).start()


def read_daily_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The current rows per day written by :func:`start_daily_counts`."""
    rows = spark.read.schema("d date, n bigint, batch bigint").parquet(out_path)
    return rows.groupBy("d").agg(F.max_by("n", "batch").alias("n"))


def order_key(fields: list, key: str = "order_id"):
    """Column that tells orders apart: the id, or for an order without one a
    hash of all its fields (a replay repeats them all)."""
    every = F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)
    return F.when(has_key(key), F.concat(F.lit("id "), F.col(key))).otherwise(F.concat(F.lit("row "), every))


def dedup_stream(good_stream: DataFrame, key: str = "order_id", event_time: str = "kafka_timestamp",
                 delay: str = "10 minutes") -> DataFrame:
    """G1 (stream): drop replays of a key seen within ``delay`` of broker
    time; state is bounded by the watermark. ``key`` must tell rows apart
    (:func:`order_key`). Start the query with ``start_stateful`` so its state
    partitions are sized to the cluster, and end a bounded run with
    :func:`require_no_late_rows`: a row later than ``delay`` would be lost."""
    return good_stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def start_stateful(writer, spark: SparkSession, cfg: IngestConfig | None = None) -> StreamingQuery:
    """Start a stateful streaming write with sized state partitions and the
    configured state store."""
    with _stateful_session(spark, cfg):
        return writer.start()
