"""Runs that land the published topics: the stream form (availableNow over
the topic files) and the bounded batch load (S9), each in its own folder
under the shared work root."""

from __future__ import annotations

import atexit
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import IngestConfig, ensure_session_defaults, work_root
from ..operators.dims import coded
from ..operators.transform import landed_orders, landed_pricing, orders_flagged, pricing_flagged
from ..schemas import ORDERS_TOPIC, PRICING_TOPIC
from ..sources import snapshots
from ..sources.fixtures import PUBLISH_LOCK, fixture_root, publish_topics
from ..sources.kafka import record_files
from ..sources.tables import compact, hadoop_fs, path_exists
from ..streaming.sinks import read_audit, read_landed, table_exists_in, write_batch_load
from ..streaming.streams import drain, run_streams
from .reports import latest_audit

# Micro-batches of the file form: half of a topic's files each (a topic has
# one file per shuffle partition), so a bounded run has several batches and
# each batch has at least as many input splits as the cluster has cores.
TRIGGERS_PER_TOPIC = 2
AUDITED_BY = {"orders": "orders", "pricing_events": "pricing"}      # table -> its stream


def files_per_trigger(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // TRIGGERS_PER_TOPIC)


def new_run_dir(spark: SparkSession, kind: str) -> str:
    """A folder for one run's tables and checkpoints; deleted when this
    driver ends, since only results read in its session depend on it."""
    path = f"{work_root(spark)}/runs/{kind}-{uuid.uuid4().hex[:12]}"
    atexit.register(drop_folder, spark, path)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    try:
        fs = hadoop_fs(spark, path)
        if fs is not None:
            fs[0].delete(fs[1], True)
    except Exception:  # noqa: BLE001 - the session is already closed
        return


def stream_land(spark: SparkSession, sf_dir: str, base: str, mode: str = "both",
                cfg: IngestConfig | None = None) -> str:
    """Land the topics with the streaming ingestion queries, availableNow,
    a few files per micro-batch; returns the sink root."""
    ensure_session_defaults(spark)
    topics = {"orders": (ORDERS_TOPIC,), "pricing": (PRICING_TOPIC,), "both": (ORDERS_TOPIC, PRICING_TOPIC)}[mode]
    root = publish_topics(spark, sf_dir, topics=topics)
    cfg = (cfg or IngestConfig()).with_(sink_root=f"{base}/landed", checkpoint_root=f"{base}/checkpoints",
                                          max_files_per_trigger=files_per_trigger(spark))
    paths = {ORDERS_TOPIC: f"{root}/{ORDERS_TOPIC}", PRICING_TOPIC: f"{root}/{PRICING_TOPIC}"}
    drain(run_streams(spark, mode, cfg, topic_paths=paths, available_now=True))
    return cfg.sink_root


def shared_landing(spark: SparkSession, sf_dir: str, force: bool = False, tables=("orders", "pricing_events")) -> str:
    """Sink root of the landed tables the reports read: each stream is landed
    once per published input, when a report first reads its table, and reused. The
    streams of one input share a folder (both run together if neither has
    landed); small pointer files name it, written only after the streams drained."""
    pointers = fixture_root(spark, sf_dir).replace("/topics/", "/landing/")
    with PUBLISH_LOCK:
        done = {} if force else {name: spark.read.text(f"{pointers}/{name}/CURRENT").first()[0] for name in AUDITED_BY.values()
                                 if path_exists(spark, f"{pointers}/{name}/CURRENT/_SUCCESS")}
        todo = [AUDITED_BY[t] for t in AUDITED_BY if AUDITED_BY[t] not in done and (force or t in tables)]
        if not todo:
            return done[AUDITED_BY[tables[0]]]
        base = (next(iter(done.values())).removesuffix("/landed") if done
                else f"{work_root(spark)}/runs/landing-{uuid.uuid4().hex[:12]}")      # kept: the pointers name it
        sink = stream_land(spark, sf_dir, base, "both" if len(todo) == 2 else todo[0])
        for name in todo:
            spark.range(1).select(F.lit(sink).alias("value")).coalesce(1).write.mode("overwrite").text(f"{pointers}/{name}/CURRENT")
        return sink


def landed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return read_landed(spark, shared_landing(spark, sf_dir, tables=(table,)), table)


def batch_load(spark: SparkSession, sf_dir: str, base: str, load_id: str = "L0") -> dict:
    """S9 + K2: the same transforms over a bounded read of the topics."""
    ensure_session_defaults(spark)
    root = publish_topics(spark, sf_dir, topics=(ORDERS_TOPIC, PRICING_TOPIC))
    out = f"{base}/landed"
    counts = {}
    for table, topic, flag, shape in (("orders", ORDERS_TOPIC, orders_flagged, landed_orders),
                                      ("pricing_events", PRICING_TOPIC, pricing_flagged, landed_pricing)):
        recs = record_files(spark, f"{root}/{topic}")
        counts[table] = write_batch_load(flag(recs), shape, out, table, load_id)
    return {"root": out, "counts": counts}


def count_landed(spark: SparkSession, root: str, table: str) -> int:
    """Rows of a landed table (0 when it does not exist yet)."""
    if not table_exists_in(spark, root, table):
        return 0
    return read_landed(spark, root, table).agg(F.count(F.lit(1))).first()[0]


TARGET_BYTES = 512 << 20       # of a merged file
SORT_ROWS = 1 << 21            # of a merged file: one task sorts them (about 0.9 GB in memory, 80 MB of zstd orders)
MERGE_AT = 8                   # small merged files that are merged without a new batch
# event_date is the day of the timestamp: the order by timestamp is one by day, and its sort compares one number
ORDER = {"good": ["timestamp", "partition", "offset"], "bad": ["kafka_timestamp", "partition", "offset"]}


# columns that are shuffled as one number each group, if they take few combinations
CODED = [["event_type", "price_tier", "competitor", "region", "city", "payment_method", "customer_segment", "is_returned", "in_stock", "is_undercut"],
         ["category", "brand"], ["product_name"], ["topic", "batch", "discount_percent", "quantity"]]


def _merge(spark: SparkSession, df: DataFrame, status: str, dst: str, files: int | None, target_bytes: int, rows: int) -> list:
    """Write ``rows`` rows as files of about ``target_bytes`` or ``SORT_ROWS`` rows, whichever
    is less, each a stretch of days, and describe them. A hot day is several files."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    files = files or max(1, -(-size // target_bytes), -(-rows // SORT_ROWS))
    codes = [coded(df, [c for c in cols if c in df.columns], f"_code{i}") for i, cols in enumerate(CODED)]
    small = reduce(lambda x, c: c[0](x), codes, df)
    placed = reduce(lambda x, c: c[1](x), codes, small.repartitionByRange(files, *ORDER[status])).select(*df.columns)
    compact(placed.sortWithinPartitions(*ORDER[status]).write).parquet(dst)         # last: a sort below a join is dropped
    day = F.col("event_date") if status == "good" else F.to_date("kafka_timestamp")
    found = (spark.read.schema("event_date date, kafka_timestamp timestamp").parquet(dst)
             .groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
             .agg(F.count(F.lit(1)).alias("n"), F.min(day).alias("lo"), F.max(day).alias("hi")).collect())
    return [snapshots.File(r.path, status, r.n, r.size, r.lo, r.hi) for r in found]


def compact_landed(spark: SparkSession, root: str, table: str, files: int | None = None, target_bytes: int = TARGET_BYTES) -> list:
    """Fold the stream batches that are complete (their latest audit row is
    ``ok``) and not folded yet, together with merged files that are still
    small (less than half of ``target_bytes`` and of ``SORT_ROWS``), into files of about
    ``target_bytes`` or ``SORT_ROWS``, and commit a snapshot; returns the names of the batches. A batch in flight or failed is left alone, and is folded by a
    later call once it is complete. Nothing is committed unless as many rows
    were written as the audit and the manifest promise; a crash before the
    commit leaves files that no reader knows."""
    snap = snapshots.current(spark, root, table)
    there = [b for b in snapshots.list_batches(spark, root, table)
             if snapshots.stream_id(b) is not None and not snap.has(snapshots.stream_id(b))]
    complete = {}
    if there and path_exists(spark, f"{root}/audit"):
        first = min(map(snapshots.stream_id, there))
        audit = read_audit(spark, root).where((F.col("query") == AUDITED_BY[table]) & (F.col("batch_id") >= first))
        complete = {r.batch_id: r for r in latest_audit(audit).where("status IN ('ok', 'empty')").select("batch_id", "n_in", "n_good", "n_bad").collect()}
    fold = [b for b in there if snapshots.stream_id(b) in complete]
    ids = [snapshots.stream_id(b) for b in fold]
    small = [f for f in snap.files if f.bytes < target_bytes // 2 and f.rows < SORT_ROWS // 2]
    if not fold and len(small) < MERGE_AT:
        return []
    made, dst = [], f"{root}/{table}_files/gen={uuid.uuid4().hex[:12]}"
    for status in ORDER:
        parts = []
        if fold:
            batches = snapshots.batch_files(spark, root, table, *(f"{root}/{table}/batch={b}" for b in fold))
            parts.append(batches.where(F.col("status") == status).drop("status"))
        old = [f.path for f in small if f.status == status]
        if old:
            parts.append(snapshots.merged_files(spark, table, old))
        if parts:
            rows = sum(complete[i][f"n_{status}"] for i in ids) + sum(f.rows for f in small if f.status == status)
            made += _merge(spark, reduce(DataFrame.unionByName, parts), status, f"{dst}/status={status}", files, target_bytes, rows)
    want, got = sum(complete[i].n_in for i in ids) + sum(f.rows for f in small), sum(f.rows for f in made)
    if want != got:
        raise RuntimeError(f"{table}: {got} rows were merged, {want} are on record")
    snapshots.commit(spark, root, table, snap, [f for f in snap.files if f not in small] + made,
                     [*snap.folded, *((i, i) for i in ids)],
                     [*(f"{root}/{table}/batch={b}" for b in fold), *(f.path for f in small)])
    return fold


def retire(spark: SparkSession, root: str, table: str) -> int:
    """Delete what the newest snapshot retired without waiting for the next
    compaction (when no query planned before it is running); returns how many
    folders and files were deleted."""
    snap = snapshots.current(spark, root, table)
    if snap.retired:
        snapshots.commit(spark, root, table, snap, snap.files, snap.folded, ())
    return len(snap.retired)
