"""Registered queries (one per inventory item or small group) and, beside
each, the SQL of its expected result over the base tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import oracle as O
from ..config import IngestConfig, ensure_session_defaults
from ..functions.parse import to_ntz
from ..operators.transform import (
    landed_orders,
    landed_pricing,
    orders_flagged,
    pricing_flagged,
)
from ..operators.dedup import first_per_key
from ..operators.validate import bad_rows, good_rows
from ..functions.business import price_position
from ..schemas import ORDER_FIELDS, ORDERS_TOPIC, PRICING_FIELDS, PRICING_TOPIC
from ..sources.fixtures import TOPICS, publish_topics
from ..sources.kafka import record_files, record_files_stream
from ..sources.snapshots import batch_files, list_batches, stream_id
from ..streaming.partials import read_partials, records_at, stored_offset_gaps, stored_rows_per_day, stored_summary, write_coordinates
from ..streaming.sinks import quarantine_exists, read_audit, read_landed, read_quarantine, read_unique, write_batch_load
from ..streaming.streams import (dedup_stream, drain, order_key, orders_lander, read_daily_counts, require_no_late_rows, start_daily_counts,
                                 start_routed_ingest, start_stateful)
from . import landing, reports

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None):
    """Register a query (and its oracle SQL). Every registered query first
    pins the session time zone to UTC (R5)."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir, *args, **kwargs):
            ensure_session_defaults(spark)
            return fn(spark, sf_dir, *args, **kwargs)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def records(spark: SparkSession, sf_dir: str, *topics) -> DataFrame:
    ensure_session_defaults(spark)
    root = publish_topics(spark, sf_dir, topics=topics or TOPICS)
    return record_files(spark, [f"{root}/{t}" for t in (topics or TOPICS)])


def _typed(fields) -> list:
    return [to_ntz("timestamp").alias("timestamp") if f == "timestamp" else F.col(f) for f in fields]


def _kafka_cols() -> list:
    return ["topic", "partition", "offset", to_ntz("kafka_timestamp").alias("kafka_timestamp")]


# ---- parse, validate, route -------------------------------------------------

@register("orders_parsed", O.with_events(f"SELECT {O.ORDER_COLS}, {O.KAFKA_COLS} FROM orders_parsed"))
def orders_parsed(spark, sf_dir):
    """Every orders record, typed (malformed -> NULL fields)."""
    p = orders_flagged(records(spark, sf_dir, ORDERS_TOPIC))
    return p.select(*_typed(ORDER_FIELDS), *_kafka_cols())


@register("pricing_parsed", O.with_events(f"SELECT {O.PRICING_COLS}, {O.KAFKA_COLS} FROM pricing_parsed",
                                          orders=False, pricing=True))
def pricing_parsed(spark, sf_dir):
    p = pricing_flagged(records(spark, sf_dir, PRICING_TOPIC))
    return p.select(*_typed(PRICING_FIELDS), *_kafka_cols())


@register("orders_good", O.with_events(
    f"SELECT {O.ORDER_COLS}, CAST(\"timestamp\" AS DATE) AS event_date FROM orders_flagged WHERE NOT bad_nulls"))
def orders_good(spark, sf_dir):
    """P7 + F1: rows that pass the default (NULL) validator, landed shape."""
    return landed_orders(good_rows(orders_flagged(records(spark, sf_dir, ORDERS_TOPIC))))


_REASONS_SQL = ("concat_ws(',', CASE WHEN order_id IS NULL THEN 'order_id_null' END, "
                "CASE WHEN product_id IS NULL THEN 'product_id_null' END, "
                "CASE WHEN \"timestamp\" IS NULL THEN 'timestamp_null' END)")


@register("orders_quarantine", O.with_events(
    f"SELECT {O.KAFKA_COLS}, {_REASONS_SQL} AS quality_reasons FROM orders_flagged WHERE bad_nulls"))
def orders_quarantine(spark, sf_dir):
    """F2 + K3: rows that fail it, with their coordinates and reasons."""
    bad = bad_rows(orders_flagged(records(spark, sf_dir, ORDERS_TOPIC)))
    return bad.select(*_kafka_cols(),
                      F.array_join(F.array_sort("quality_reasons"), ",").alias("quality_reasons"))


@register("orders_strict", O.with_events(
    f"SELECT {O.ORDER_COLS}, CAST(\"timestamp\" AS DATE) AS event_date FROM orders_flagged WHERE NOT bad_strict"))
def orders_strict(spark, sf_dir):
    """the strict (truthiness) validator."""
    return landed_orders(good_rows(orders_flagged(records(spark, sf_dir, ORDERS_TOPIC), "strict")))


@register("pricing_undercut", O.with_events(
    f"SELECT {O.PRICING_COLS}, coalesce(price_diff < 0, false) AS is_undercut, "
    "CAST(\"timestamp\" AS DATE) AS event_date, "
    "CASE WHEN price_diff > 0 THEN 'cheaper' WHEN price_diff IS NOT NULL THEN 'pricier' END AS position "
    "FROM pricing_parsed", orders=False, pricing=True))
def pricing_undercut(spark, sf_dir):
    """P8 + D5: the undercut flag and the competitor's price position."""
    p = landed_pricing(pricing_flagged(records(spark, sf_dir, PRICING_TOPIC)))
    return p.withColumn("position", price_position("price_diff"))


@register("topic_routing", O.with_events(
    "SELECT 'orders' AS route, count(*) AS n_records, count(*) FILTER (WHERE defect = 'tombstone') AS n_tombstones, "
    "count(*) FILTER (WHERE defect <> 'tombstone') AS n_routed FROM orders_parsed "
    "UNION ALL SELECT 'pricing', count(*), 0, count(*) FROM pricing_parsed "
    "UNION ALL SELECT 'unrouted', (SELECT count(*) FROM events), 0, 0", pricing=True))
def topic_routing(spark, sf_dir):
    """S5 + F4 + F5: one scan of all topics, routed by topic; tombstones are
    dropped from the routes; unknown topics reach no route."""
    recs = records(spark, sf_dir)
    route = (F.when(F.col("topic") == ORDERS_TOPIC, "orders")
             .when(F.col("topic") == PRICING_TOPIC, "pricing").otherwise("unrouted"))
    tomb = F.col("value").isNull()
    return (recs.groupBy(route.alias("route"))
            .agg(F.count(F.lit(1)).alias("n_records"),
                 F.count_if(tomb).alias("n_tombstones"),
                 F.count_if(~tomb & (route != "unrouted")).alias("n_routed")))


# ---- reports ------------------------------------------------------------------

@register("orders_rows_per_day", O.with_events(
    "SELECT CAST(\"timestamp\" AS DATE) AS d, count(*) AS n FROM orders_flagged WHERE NOT bad_nulls "
    "GROUP BY 1 ORDER BY 1"))
def orders_rows_per_day(spark, sf_dir):
    """The flagship: records -> parse -> validate -> good rows -> rows per day."""
    return reports.rows_per_day(orders_good(spark, sf_dir))



_GOOD = "SELECT * FROM orders_flagged WHERE NOT bad_nulls"
_LANDED_ORDERS_SQL = f"SELECT {O.ORDER_COLS}, CAST(\"timestamp\" AS DATE) AS event_date FROM orders_flagged WHERE NOT bad_nulls"
_LANDED_PRICING_SQL = (f"SELECT {O.PRICING_COLS}, coalesce(price_diff < 0, false) AS is_undercut, "
                       "CAST(\"timestamp\" AS DATE) AS event_date FROM pricing_parsed")


@register("rows_per_day_head_tail", O.with_events(
    f", per_day AS (SELECT CAST(\"timestamp\" AS DATE) AS d, count(*) AS n FROM ({_GOOD}) GROUP BY 1), "
    "r AS (SELECT *, row_number() OVER (ORDER BY d ASC NULLS FIRST) AS rn, "
    "row_number() OVER (ORDER BY d DESC NULLS LAST) AS rd, count(*) OVER () AS total FROM per_day) "
    "SELECT d, n, CASE WHEN total <= 10 THEN 'all' WHEN rn <= 5 THEN 'head' ELSE 'tail' END AS part, "
    "rn AS rank FROM r WHERE total <= 10 OR rn <= 5 OR rd <= 5"))
def rows_per_day_head_tail(spark, sf_dir):
    """A3 + L2 on the landed orders table."""
    return reports.head_tail(reports.rows_per_day(landing.landed(spark, sf_dir, "orders")))


@register("table_summary", O.with_events(
    "SELECT 'orders' AS table_name, 'ok' AS status, count(*) AS n, min(\"timestamp\") AS mn, "
    "max(\"timestamp\") AS mx, count(DISTINCT CAST(\"timestamp\" AS DATE)) AS n_days "
    f"FROM ({_GOOD}) "
    "UNION ALL SELECT 'orders_quarantine', 'ok', count(*), min(kafka_timestamp), max(kafka_timestamp), "
    "count(DISTINCT CAST(kafka_timestamp AS DATE)) FROM orders_flagged WHERE bad_nulls "
    "UNION ALL SELECT 'pricing_events', 'ok', count(*), min(\"timestamp\"), max(\"timestamp\"), "
    "count(DISTINCT CAST(\"timestamp\" AS DATE)) FROM pricing_parsed "
    "UNION ALL SELECT 'pricing_events_quarantine', 'missing', NULL, NULL, NULL, NULL", pricing=True))
def table_summary(spark, sf_dir):
    """S7 + S8 + A1 + A2 + A9: one summary row per landed table in one scan
    each; the pricing quarantine is off by default, so it reports missing."""
    root = landing.shared_landing(spark, sf_dir)

    def quarantine(table):
        return read_quarantine(spark, root, table) if quarantine_exists(spark, root, table) else None

    return reports.table_report(spark, {
        "orders": (read_landed(spark, root, "orders"), "timestamp"),
        "orders_quarantine": (quarantine("orders"), "kafka_timestamp"),
        "pricing_events": (read_landed(spark, root, "pricing_events"), "timestamp"),
        "pricing_events_quarantine": (quarantine("pricing_events"), "kafka_timestamp"),
    })


_ORDER_LINE_SQL = ("concat_ws(' | ', rpad(coalesce(substr(product_name, 1, 35), ''), 35, ' '), "
                   "lpad(coalesce(format('{:,.2f}', final_price), ''), 10, ' '), "
                   "rpad(coalesce(substr(region, 1, 12), ''), 12, ' '), coalesce(payment_method, ''))")


_PRICING_LINE_SQL = ("concat_ws(' | ', rpad(coalesce(substr(competitor, 1, 18), ''), 18, ' '), "
                     "lpad(coalesce(format('{:,.2f}', competitor_price), ''), 10, ' '), "
                     "lpad(coalesce(format('{:,.2f}', our_price), ''), 10, ' '), "
                     "coalesce(CASE WHEN price_diff > 0 THEN 'cheaper' WHEN price_diff IS NOT NULL THEN 'pricier' END, "
                     "''))")


@register("preview_first_n", O.with_events(
    ", fo AS (SELECT *, row_number() OVER (ORDER BY \"partition\", \"offset\") AS rn FROM orders_parsed "
    "WHERE defect <> 'tombstone'), "
    "fp AS (SELECT *, row_number() OVER (ORDER BY \"partition\", \"offset\") AS rn FROM pricing_parsed) "
    f"SELECT topic, \"partition\", \"offset\", rn, order_id AS event_key, {_ORDER_LINE_SQL} AS line FROM fo "
    "WHERE rn <= 3 "
    f"UNION ALL SELECT topic, \"partition\", \"offset\", rn, product_id, {_PRICING_LINE_SQL} FROM fp WHERE rn <= 3",
    pricing=True))
def preview_first_n(spark, sf_dir, n: int = 3):
    """L3 + L4 + D12 + K5: the first n present events of each stream in log
    order, with their fixed-width console lines."""

    rn = F.row_number().over(Window.partitionBy("topic").orderBy("partition", "offset"))  # over n rows only
    out = []
    for topic, flag, line, key in ((ORDERS_TOPIC, orders_flagged, reports.preview_line, "order_id"),
                                   (PRICING_TOPIC, pricing_flagged, reports.pricing_preview_line, "product_id")):
        first = reports.preview_first(records(spark, sf_dir, topic), n)
        parsed = line(flag(first)).withColumn("rn", rn.cast("bigint"))
        out.append(parsed.select("topic", "partition", "offset", "rn", F.col(key).alias("event_key"), "line"))
    return out[0].unionByName(out[1])


@register("offset_gaps", O.with_events(
    "SELECT topic, \"partition\", min(\"offset\") AS min_offset, max(\"offset\") AS max_offset, count(*) AS n, "
    "count(DISTINCT \"offset\") AS n_distinct, max(\"offset\") - min(\"offset\") + 1 - count(DISTINCT \"offset\") "
    "AS missing FROM (SELECT topic, \"partition\", \"offset\" FROM orders_parsed UNION ALL "
    "SELECT topic, \"partition\", \"offset\" FROM pricing_parsed UNION ALL "
    "SELECT 'other-topic', 0, event_id FROM events) "
    "WHERE \"offset\" % 97 NOT BETWEEN 13 AND 15 GROUP BY 1, 2", pricing=True))
def offset_gaps(spark, sf_dir):
    """Per topic partition, offsets missing inside the observed range, on
    a log that has lost three offsets in each 97."""
    kept = records(spark, sf_dir).where(~(F.col("offset") % 97).between(13, 15))
    return reports.offset_gaps(kept)


@register("batch_audit_totals", O.with_events(
    "SELECT 'orders' AS query, count(*) AS n_in, count(*) FILTER (WHERE NOT bad_nulls) AS n_good, "
    "count(*) FILTER (WHERE bad_nulls) AS n_bad, true AS all_ok FROM orders_flagged "
    "UNION ALL SELECT 'pricing', count(*), count(*), 0, true FROM pricing_parsed", pricing=True))
def batch_audit_totals(spark, sf_dir):
    """A4 + A5 + A7 + T8: per-batch audit rows of the ingestion streams,
    totalled per query (batch boundaries are ours, totals are not)."""
    audit = reports.latest_audit(read_audit(spark, landing.shared_landing(spark, sf_dir)))
    return (audit.groupBy("query")
            .agg(F.sum("n_in").alias("n_in"), F.sum("n_good").alias("n_good"), F.sum("n_bad").alias("n_bad"),
                 F.bool_and(F.col("status").isin("ok", "empty")).alias("all_ok")))


@register("running_totals", O.with_events(
    "SELECT 'orders' AS query, count(*) AS cum_in, count(*) FILTER (WHERE NOT bad_nulls) AS cum_good, "
    "count(*) FILTER (WHERE bad_nulls) AS cum_bad, CAST(0 AS BIGINT) AS n_steps_back FROM orders_flagged "
    "UNION ALL SELECT 'pricing', count(*), count(*), 0, 0 FROM pricing_parsed", pricing=True))
def running_totals(spark, sf_dir):
    """A5: the running totals of each ingestion query after its last batch
    (batch boundaries are ours), and how often a total went down."""
    audit = reports.latest_audit(read_audit(spark, landing.shared_landing(spark, sf_dir)))
    t = reports.running_totals(audit)
    back = F.col("cum_in") < F.coalesce(F.lag("cum_in").over(Window.partitionBy("query").orderBy("batch_id")), F.lit(0))
    return (t.withColumn("back", back).groupBy("query")
            .agg(F.max_by("cum_in", "batch_id").alias("cum_in"), F.max_by("cum_good", "batch_id").alias("cum_good"),
                 F.max_by("cum_bad", "batch_id").alias("cum_bad"), F.count_if("back").alias("n_steps_back")))


@register("batch_reconciliation", O.with_events(
    "SELECT 'orders' AS table_name, count(*) AS n_in, count(*) FILTER (WHERE NOT bad_nulls) AS n_landed, "
    "count(*) FILTER (WHERE bad_nulls) AS n_quarantined, CAST(0 AS BIGINT) AS n_batches_off FROM orders_flagged "
    "UNION ALL SELECT 'pricing_events', count(*), count(*), 0, 0 FROM pricing_parsed", pricing=True))
def batch_reconciliation(spark, sf_dir):
    """Of each table and batch, the rows the audit expects against the
    rows in its files; totals, and the batches that differ."""
    root = landing.shared_landing(spark, sf_dir)
    out = None
    for query, table in (("orders", "orders"), ("pricing", "pricing_events")):
        r = reports.batch_reconciliation(read_audit(spark, root), query, read_landed(spark, root, table, with_batch=True),
                                         read_quarantine(spark, root, table))
        row = r.agg(F.lit(table).alias("table_name"), F.sum("n_in").alias("n_in"), F.sum("n_landed").alias("n_landed"),
                    F.sum("n_quarantined").alias("n_quarantined"), F.count_if(~F.col("ok")).alias("n_batches_off"))
        out = row if out is None else out.unionByName(row)
    return out


@register("stream_orders_landed", O.with_events(_LANDED_ORDERS_SQL))
def stream_orders_landed(spark, sf_dir):
    """S1 (file form) + S3 + T1-T6 + K1 + F6: the orders stream, a few files
    per micro-batch, landed batch by batch; read back = the good rows."""
    base = landing.new_run_dir(spark, "orders-stream")
    sink = landing.stream_land(spark, sf_dir, base, "orders")
    return read_landed(spark, sink, "orders")


@register("stream_pricing_landed", O.with_events(_LANDED_PRICING_SQL, orders=False, pricing=True))
def stream_pricing_landed(spark, sf_dir):
    """S2 (file form) + P8 + K1: the pricing stream."""
    base = landing.new_run_dir(spark, "pricing-stream")
    sink = landing.stream_land(spark, sf_dir, base, "pricing")
    return read_landed(spark, sink, "pricing_events")


@register("stream_multi_topic", O.with_events(
    "SELECT 'orders' AS route, count(*) FILTER (WHERE NOT bad_nulls) AS n_landed, "
    "count(*) FILTER (WHERE bad_nulls) AS n_quarantined FROM orders_flagged "
    "UNION ALL SELECT 'pricing', count(*), 0 FROM pricing_parsed", pricing=True))
def stream_multi_topic(spark, sf_dir):
    """S5 + F4 (stream form): one subscription to every topic file, routed
    per micro-batch; the unknown topic lands nowhere."""
    ensure_session_defaults(spark)
    root = publish_topics(spark, sf_dir)
    base = landing.new_run_dir(spark, "routed")
    src = record_files_stream(spark, f"{root}/*-topic", 3 * landing.files_per_trigger(spark))
    drain([start_routed_ingest(src, IngestConfig(), f"{base}/landed", f"{base}/checkpoint", available_now=True,
                               cache_raw=False)])
    out = None
    for route, table in (("orders", "orders"), ("pricing", "pricing_events")):
        landed_n = read_landed(spark, f"{base}/landed", table).agg(F.count(F.lit(1))).scalar()
        q = (read_quarantine(spark, f"{base}/landed", table).agg(F.count(F.lit(1))).scalar()
             if quarantine_exists(spark, f"{base}/landed", table) else F.lit(0).cast("bigint"))
        row = spark.range(1).select(F.lit(route).alias("route"), landed_n.alias("n_landed"),
                                    q.alias("n_quarantined"))
        out = row if out is None else out.unionByName(row)
    return out


@register("stream_replay_idempotent", O.with_events(
    f"SELECT count(*) AS n_rows, count(DISTINCT order_id) AS n_ids FROM ({_GOOD})"))
def stream_replay_idempotent(spark, sf_dir):
    """G2 + T2 + T7: run the orders stream; restart it on the same
    checkpoint (must add nothing); then land the records of its last
    micro-batch again under the same id, as Spark does with a batch that was
    written but not committed: it overwrites its own output, so the table is unchanged."""
    base = landing.new_run_dir(spark, "replay")
    landing.stream_land(spark, sf_dir, base, "orders")
    sink = landing.stream_land(spark, sf_dir, base, "orders")
    last = list_batches(spark, sink, "orders")[-1]
    write_coordinates(batch_files(spark, sink, "orders", f"{sink}/orders/batch={last}"), f"{base}/replayed")
    replayed = records_at(records(spark, sf_dir, ORDERS_TOPIC), f"{base}/replayed")
    orders_lander(sink)(replayed, stream_id(last))
    df = read_landed(spark, sink, "orders")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("order_id").alias("n_ids"))


@register("load_reconciliation", O.with_events(
    "SELECT 'orders' AS table_name, CAST(0 AS BIGINT) AS n_before, count(*) AS n_in, "
    "count(*) FILTER (WHERE NOT bad_nulls) AS n_landed, count(*) FILTER (WHERE bad_nulls) AS n_quarantined, "
    "CAST(0 AS BIGINT) AS diff, true AS ok FROM orders_flagged "
    "UNION ALL SELECT 'pricing_events', 0, count(*), count(*), 0, 0, true FROM pricing_parsed", pricing=True))
def load_reconciliation(spark, sf_dir):
    """S9 + K2 + A6 + A8: a bounded load with the stream's transforms; table
    sizes before and after, input vs landed + quarantined."""
    base = landing.new_run_dir(spark, "load")
    before = {t: landing.count_landed(spark, f"{base}/landed", t) for t in ("orders", "pricing_events")}
    res = landing.batch_load(spark, sf_dir, base)
    root = publish_topics(spark, sf_dir, topics=(ORDERS_TOPIC, PRICING_TOPIC))
    rows = []
    for table, topic in (("orders", ORDERS_TOPIC), ("pricing_events", PRICING_TOPIC)):
        def count_of(df):
            return df.agg(F.count(F.lit(1))).scalar()

        n_in = count_of(record_files(spark, f"{root}/{topic}"))
        n_landed = count_of(read_landed(spark, res["root"], table))
        n_quarantined = count_of(read_quarantine(spark, res["root"], table))
        observed = res["counts"][table]
        row = spark.range(1).select(
            F.lit(table).alias("table_name"), F.lit(before[table]).cast("bigint").alias("n_before"),
            n_in.alias("n_in"), n_landed.alias("n_landed"), n_quarantined.alias("n_quarantined"),
            (n_in - n_landed - n_quarantined).alias("diff"))
        ok = ((F.col("diff") == 0) & (F.col("n_landed") == observed["good"])
              & (F.col("n_quarantined") == observed["bad"]))
        rows.append(row.withColumn("ok", ok))
    return rows[0].unionByName(rows[1])


@register("stream_rows_per_day", O.with_events(
    f"SELECT CAST(\"timestamp\" AS DATE) AS d, count(*) AS n FROM ({_GOOD}) GROUP BY 1"))
def stream_rows_per_day(spark, sf_dir):
    """The live rows-per-day aggregate, run to the end of the topic."""
    ensure_session_defaults(spark)
    root = publish_topics(spark, sf_dir, topics=(ORDERS_TOPIC,))
    base = landing.new_run_dir(spark, "daily")
    src = record_files_stream(spark, f"{root}/{ORDERS_TOPIC}", landing.files_per_trigger(spark))
    good = landed_orders(good_rows(orders_flagged(src)))
    q = start_daily_counts(good, f"{base}/daily", f"{base}/checkpoint", IngestConfig(), available_now=True)
    drain([q])
    return read_daily_counts(spark, f"{base}/daily")


@register("orders_compacted", O.with_events(_LANDED_ORDERS_SQL))
def orders_compacted(spark, sf_dir):
    """K2 + S7: a landing of its own is folded into files of a target size and
    the folded batches are deleted; the table read back from the snapshot is
    the landed rows."""
    root = landing.stream_land(spark, sf_dir, landing.new_run_dir(spark, "compact"), "orders")
    landing.compact_landed(spark, root, "orders")
    landing.retire(spark, root, "orders")
    return read_landed(spark, root, "orders")


@register("stream_dedup", O.with_events(
    f"SELECT order_id FROM ({_GOOD}) WHERE trim(order_id) <> '' GROUP BY order_id "
    f"UNION ALL SELECT order_id FROM (SELECT DISTINCT {O.ORDER_COLS} FROM ({_GOOD}) "
    "WHERE trim(coalesce(order_id, '')) = '')"))
def stream_dedup(spark, sf_dir):
    """G1 (stream): an order id seen again within 10 minutes of broker time
    (replays are adjacent in the log) is dropped; the watermark on the
    broker's append time bounds the state. Orders without an id are dropped
    only if every field repeats. Output: the surviving ids."""
    return run_stream_dedup(spark, sf_dir, landing.files_per_trigger(spark), "10 minutes")


def run_stream_dedup(spark, sf_dir, files_per_trigger: int | None, delay: str) -> DataFrame:
    """The stream dedup over the published orders, to the end of the topic;
    fails if the watermark dropped a row."""
    ensure_session_defaults(spark)
    root = publish_topics(spark, sf_dir, topics=(ORDERS_TOPIC,))
    base = landing.new_run_dir(spark, "dedup")
    src = record_files_stream(spark, f"{root}/{ORDERS_TOPIC}", files_per_trigger)
    good = good_rows(orders_flagged(src)).withColumn("dedup_key", order_key(ORDER_FIELDS))
    w = (dedup_stream(good.select("order_id", "dedup_key", "kafka_timestamp"), "dedup_key", "kafka_timestamp", delay).writeStream
         .format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
         .outputMode("append").trigger(availableNow=True))
    q = start_stateful(w, spark)
    drain([q])
    require_no_late_rows(q)
    return spark.read.schema("order_id string").parquet(f"{base}/out")


@register("orders_dedup", O.with_events(
    f", ranked AS (SELECT *, row_number() OVER (PARTITION BY order_id, CASE WHEN trim(coalesce(order_id, '')) = '' "
    f"THEN ROW({O.ORDER_COLS}) END ORDER BY \"timestamp\" NULLS FIRST, "
    "event_type NULLS FIRST, product_id NULLS FIRST, product_name NULLS FIRST, category NULLS FIRST, "
    "brand NULLS FIRST, price_tier NULLS FIRST, base_price NULLS FIRST, final_price NULLS FIRST, "
    "discount_percent NULLS FIRST, quantity NULLS FIRST, total_value NULLS FIRST, region NULLS FIRST, "
    "city NULLS FIRST, payment_method NULLS FIRST, customer_segment NULLS FIRST, is_returned NULLS FIRST) AS rn "
    f"FROM ({_GOOD})) SELECT {O.ORDER_COLS}, CAST(\"timestamp\" AS DATE) AS event_date FROM ranked WHERE rn = 1"))
def orders_dedup(spark, sf_dir):
    """G1 (batch): one row per order id, the first by timestamp then by
    every other column; orders without an id are kept unless every field
    repeats."""

    return first_per_key(landing.landed(spark, sf_dir, "orders"), "order_id",
                         ["timestamp"] + [c for c in ORDER_FIELDS if c not in ("order_id", "timestamp")])


@register("orders_unique", ORACLE["orders_dedup"])
def orders_unique(spark, sf_dir):
    """G1 (stream, without a watermark): each order's first arrival, decided
    per micro-batch by an index of all ids landed before."""
    base = landing.new_run_dir(spark, "unique")
    return read_unique(spark, landing.stream_land(spark, sf_dir, base, "orders", IngestConfig(unique_orders=True)), "orders")


@register("rows_per_day_stored", ORACLE["orders_rows_per_day"])
def rows_per_day_stored(spark, sf_dir):
    """A3 from the partial aggregates that each batch has left: no events are read."""
    return stored_rows_per_day(read_partials(spark, landing.shared_landing(spark, sf_dir, tables=("orders",)), "orders"))


@register("table_summary_stored", ORACLE["table_summary"])
def table_summary_stored(spark, sf_dir):
    """S8 + A1 + A2 from the partial aggregates of the batches."""
    return stored_summary(spark, landing.shared_landing(spark, sf_dir), ("orders", "pricing_events"))


@register("offset_gaps_stored", O.with_events(
    "SELECT topic, \"partition\", min(\"offset\") AS min_offset, max(\"offset\") AS max_offset, count(*) AS n, "
    "count(DISTINCT \"offset\") AS n_distinct, max(\"offset\") - min(\"offset\") + 1 - count(DISTINCT \"offset\") "
    "AS missing FROM orders_parsed WHERE \"offset\" % 97 NOT BETWEEN 13 AND 15 GROUP BY 1, 2"))
def offset_gaps_stored(spark, sf_dir):
    """S4 over the life of a table: a log that lost offsets lands in several
    loads, the bitmaps of which overlap and are united."""
    root = f"{landing.new_run_dir(spark, 'gaps')}/landed"
    log = records(spark, sf_dir, ORDERS_TOPIC).where(~(F.col("offset") % 97).between(13, 15))
    for i in range(2):
        part = log.where(F.col("offset") % 2 == i)
        write_batch_load(orders_flagged(part), landed_orders, root, "orders", f"part{i}")
    return stored_offset_gaps(read_partials(spark, root, "orders"))


from . import registry_derived  # noqa: E402,F401  (registers its queries)
