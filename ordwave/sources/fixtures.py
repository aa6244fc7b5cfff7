"""Kafka-shaped order and pricing records derived from the base tables.

The producer side of the system, re-expressed as a Spark job: events are
built from ``lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ region ⋈ part``,
serialised to JSON (P10, P11), given defects by rule, and laid out as
Kafka records (topic, partition, dense offset, broker timestamp). The
records are written once per input directory into the shared work folder
and act as the topics for every batch and stream operator downstream.
"""

from __future__ import annotations

import hashlib
import os
import threading
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import ensure_session_defaults, work_root
from ..functions.parse import to_iso_text, to_json_value
from ..functions.rounding import r2
from ..functions.business import price_tier
from ..operators.dims import coded, geo_dim, product_dim, product_id
from ..operators.sequence import block_starts, dealer, ranged_sequence
from ..schemas import ORDER_FIELDS, ORDERS_TOPIC, PRICING_FIELDS, PRICING_TOPIC
from .tables import compact, file_per_task, file_states, hadoop_fs, path_exists, read_table, settings, table_path

FIXTURE_VERSION = "14"
OTHER_TOPIC = "other-topic"
TOPICS = (ORDERS_TOPIC, PRICING_TOPIC, OTHER_TOPIC)
BASE_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events")
# the total order of lineitem rows (unique at every scale factor)
TOTAL_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
               "l_extendedprice", "l_shipdate"]

# ---- fixed values: defect rules, first match wins ---------------------------
ORDER_DEFECTS = [  # (k divisor, defect)
    (59, "tombstone"), (97, "truncated"), (89, "order_id_null"), (83, "product_id_absent"),
    (79, "timestamp_bad"), (67, "timestamp_absent"), (73, "order_id_empty"),
    (71, "final_price_zero"), (61, "quantity_text"),
]
PRICING_DEFECTS = [(76, "truncated"), (116, "price_diff_absent"), (92, "price_diff_null"),
                   (84, "our_price_zero")]
REPLAY_EVERY = 50          # rows with k % 50 = 0 are published twice
PUBLISH_EPOCH = "2024-07-01 00:00:00"   # broker time of offset 0 (UTC)
LOG_APPEND_TIME = 1        # Kafka timestampType of broker-assigned times
BAND_BREAK_EVERY = 101     # rows with k % 101 = 0 get a final price outside the band
# -----------------------------------------------------------------------------


def _defect(rules) -> Column:
    k = F.col("k")
    expr = None
    for div, name in rules:
        expr = F.when(k % div == 0, name) if expr is None else expr.when(k % div == 0, name)
    return expr.otherwise("none")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(*TOTAL_ORDER, "l_discount", "l_returnflag", "l_linestatus")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with what their customer gives; nation and region are broadcast (bounded by the schema)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                                   "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(geo_dim(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("o_orderkey", "o_orderdate", "o_orderpriority", "c_mktsegment", "city", "region"))


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_dim(spark, sf_dir).select("p_partkey", "product_name", "category", "brand", "base_price")


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined line-level rows every event is made from. Customer and
    product joins are left to the size-checked planner. The columns that only
    place a line within its order become its rank there, and what follows
    from other columns (:func:`with_derived`) is left out, so the rows that are
    shuffled are small."""
    li, oc = _lines(spark, sf_dir), _orders(spark, sf_dir)
    within = Window.partitionBy("l_orderkey").orderBy(*TOTAL_ORDER[1:])
    # lineitem and orders both grow with the data: a sort-merge join on the
    # order key (never a broadcast of either)
    return (li.join(oc.hint("merge"), li.l_orderkey == oc.o_orderkey)
            .withColumn("rank", F.rank().over(within)).drop("o_orderkey", "l_extendedprice", "l_shipdate")
            .join(_products(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey"))


# columns that are shuffled as one number each group, if they take few combinations
CODED_LINE = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_discount"]
CODED_PRODUCT = {"_name": ["product_name"], "_kind": ["category", "brand"]}


def placed_rows(spark: SparkSession, sf_dir: str, ranges: int) -> DataFrame:
    """The rows of :func:`event_rows`, in ``ranges`` partitions that each hold a stretch
    of the order keys, sorted: lines meet their products first (where ``part`` is not
    broadcast), then lines and orders are dealt out by order key and meet where they stay.
    ``_blk`` is the block of a row, ``_r`` its partition, ``_at_<topic>`` how many
    records of its topic partition come before in the block. To be written
    under :data:`DEALT`."""
    li, oc, p = _lines(spark, sf_dir), _orders(spark, sf_dir), _products(spark, sf_dir)
    deal = dealer(li, "l_orderkey", ranges)
    pack_line, unpack_line = coded(li, CODED_LINE, "_line")
    names = [coded(p, cols, code) for code, cols in CODED_PRODUCT.items()]
    p = reduce(lambda x, c: c[0](x), names, p)
    lines = deal(pack_line(li).join(p, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey"), "l_orderkey")
    orders = deal(oc, "o_orderkey").drop("_blk").withColumnRenamed("_r", "_or")
    met = unpack_line(lines.join(orders.hint("merge"), (F.col("_r") == F.col("_or")) & (F.col("l_orderkey") == F.col("o_orderkey"))))
    before = (Window.partitionBy("_r", "_blk").orderBy(*TOTAL_ORDER).rowsBetween(Window.unboundedPreceding, -1))
    at = []
    for topic, n in PARTITIONS.items():
        # a running count for each topic partition (a remainder by n): one sort serves them all
        group, values = _partition(topic), range(1 - n, n)
        run = {v: F.coalesce(F.sum(F.when(group == v, _copies(topic))).over(before), F.lit(0)) for v in values}
        at.append(reduce(lambda x, v: x.when(group == v, run[v]), values, F.when(F.lit(False), F.lit(0))).cast("int").alias(_at(topic)))
    rows = met.select(*(c for c in met.columns if c not in ("_or", "o_orderkey", "l_extendedprice", "l_shipdate")), *at)
    return reduce(lambda x, c: c[1](x), names, rows)


def _k() -> Column:
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


PARTITIONS = {ORDERS_TOPIC: 3, PRICING_TOPIC: 2}
# joins by _r and more keep partitions by _r
DEALT = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def _partition(topic: str) -> Column:
    return ((_k() if topic == ORDERS_TOPIC else F.col("l_orderkey")) % PARTITIONS[topic]).cast("int")


def _copies(topic: str) -> Column:
    """Records that a line has in a topic."""
    return F.when(_k() % REPLAY_EVERY == 0, 2).otherwise(1) if topic == ORDERS_TOPIC else F.lit(1)


def _at(topic: str) -> str:
    return f"_at_{topic.removesuffix('-topic')}"


def with_derived(events: DataFrame) -> DataFrame:
    """The columns of an event that follow from those of :func:`event_rows`."""
    k = F.col("k")
    micros = (k * 37) % 82800 * 1000000 + k % 1000000
    return (events.withColumn("k", _k()).withColumn("product_id", product_id("l_partkey"))
            .withColumn("event_ts", F.timestamp_add("MICROSECOND", micros, F.col("o_orderdate"))))


def _order_id() -> Column:
    lo, lp, ls = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")

    def letter(x):
        return F.chr(F.lit(65) + x)

    def four(x):
        return F.lpad(x.cast("string"), 4, "0")

    return F.concat(F.lit("ORD-"), letter(F.col("l_linenumber")), letter(lo % 26),
                    four(F.floor(lo / 26) % 10000), letter(lp % 26), letter(ls % 26), four(lp % 10000))


# texts that are shuffled as one number, if they take few combinations
CODED = {"_line": ["l_returnflag", "l_linestatus", "o_orderpriority", "c_mktsegment", "city", "region"], "_kind": ["category", "brand"]}
POSITION = ["l_orderkey", "rank", "_copy"]      # TOTAL_ORDER, then the copies of a record


def with_offsets(rows: DataFrame, topic: str, files: int) -> DataFrame:
    """Dense offsets per partition in the total order, then the Kafka record
    columns. The broker timestamp is the log-append time (timestampType 1):
    the publish epoch plus one millisecond per offset, so it never decreases
    within a partition, as on a broker. The JSON is made last: neither
    the shuffle nor the sorts carry it, nor texts that take few values."""
    codes = [coded(rows, [c for c in cols if c in rows.columns], code) for code, cols in CODED.items()]
    df = ranged_sequence(rows, "partition", POSITION, "l_orderkey", files, out="offset",
                         pack=lambda d: reduce(lambda x, c: c[0](x), codes, d))
    return _records(reduce(lambda x, c: c[1](x), codes, df), topic)


def placed_records(placed: DataFrame, topic: str) -> DataFrame:
    """The Kafka record columns of rows that were placed (:func:`placed_rows`), each
    partition sorted by offset: a record's offset is the number of those in the blocks
    before, which is a small table, and those before it in its block. Nothing is shuffled."""
    rows = ROWS[topic](placed)
    starts = block_starts(rows, "partition", 1024)
    df = rows.join(F.broadcast(starts), ["partition", "_blk"]).withColumn("offset", (F.col("_base") + F.col(_at(topic)) + F.col("_copy") - 1).cast("bigint"))
    return _records(df.sortWithinPartitions("offset", "partition"), topic)


SLACK = 60_000     # records (milliseconds of broker time) that a topic partition may be behind another where a file begins


def advance_together(placed: DataFrame, topic: str) -> bool:
    """Do the topic partitions advance alike along the order keys, so that files
    that hold a stretch of these each are in the order of broker time?"""
    counts = (ROWS[topic](placed).groupBy("_r", "partition").agg(F.count(F.lit(1)).alias("n"), F.min("_blk").alias("first"))
              .where("partition IS NOT NULL").collect())              # a row per file and topic partition
    first, total, at = {}, Counter(), Counter()
    for r in counts:
        first[r._r] = min(r.first, first.get(r._r, r.first))
        total[r.partition] += r.n
    for stretch in sorted(first, key=first.get):
        left = [at[p] for p in total if at[p] < total[p]]
        if max(at.values(), default=0) - min(left) > SLACK:
            return False
        at.update({r.partition: r.n for r in counts if r._r == stretch})
    return True


def _records(df: DataFrame, topic: str) -> DataFrame:
    return VALUE[topic](with_derived(df)).select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value"),
        F.lit(topic).alias("topic"),
        F.col("partition"),
        F.col("offset"),
        append_time(F.col("offset")),
        F.lit(LOG_APPEND_TIME).alias("timestampType"),
    )


def append_time(offset: Column) -> Column:
    return (F.timestamp_add("MILLISECOND", offset, F.lit(PUBLISH_EPOCH).cast("timestamp_ntz"))
            .cast("timestamp").alias("timestamp"))


def _texts(df: DataFrame, fields: dict, names: list, absent: Column) -> DataFrame:
    """``_text``: the JSON of the fields, without the NULL ones where ``absent``.
    The fields are columns first, so the code of each is there once
    (with a copy in every use, the generated method is too long to be compiled)."""
    made = df.select("defect", "partition", "offset", *(fields[n].alias(f"f_{n}") for n in names))
    cols = [F.col(f"f_{n}").alias(n) for n in names]
    return made.withColumn("_text", F.when(absent, to_json_value(cols, ignore_nulls=True)).otherwise(to_json_value(cols)).cast("string"))


def _half(text: Column) -> Column:
    return F.substring(text, 1, F.floor(F.length(text) / 2).cast("int"))


def order_rows(events: DataFrame) -> DataFrame:
    """What orders-topic records are made from, a row per record (replays get
    a copy number), with the topic partition."""
    return (events.drop("l_linestatus").withColumn("_copy", F.explode(F.sequence(F.lit(1), _copies(ORDERS_TOPIC))))
            .withColumn("partition", _partition(ORDERS_TOPIC)))


def order_values(rows: DataFrame) -> DataFrame:
    """``value`` of orders-topic records, with the defect classes."""
    b = rows.withColumn("defect", _defect(ORDER_DEFECTS))
    d = F.col("defect")
    k = F.col("k")
    base = F.col("base_price")
    final = F.when(k % BAND_BREAK_EVERY == 0, r2(base * 1.20)).otherwise(r2(base * (F.lit(0.90) + k % 17 / 100)))
    qty = (F.col("l_quantity").cast("int") % 5 + 1).cast("int")
    fields = {
        "event_type": F.lit("order_placed"),
        "order_id": F.when(d == "order_id_null", F.lit(None).cast("string"))
                     .when(d == "order_id_empty", F.lit("")).otherwise(_order_id()),
        "product_id": F.when(d != "product_id_absent", F.col("product_id")),
        "product_name": F.col("product_name"),
        "category": F.col("category"),
        "brand": F.col("brand"),
        "price_tier": price_tier(base),
        "base_price": base,
        "final_price": F.when(d == "final_price_zero", F.lit(0.0)).otherwise(final),
        "discount_percent": (F.floor(F.col("l_discount") * 100 + 0.5) * (F.col("l_linenumber") % 5 + 1)
                             ).cast("double"),
        "quantity": qty,
        "total_value": r2(final * qty),
        "region": F.col("region"),
        "city": F.col("city"),
        "payment_method": F.col("o_orderpriority"),
        "customer_segment": F.col("c_mktsegment"),
        "is_returned": F.col("l_returnflag") == "R",
        "timestamp": F.when(d == "timestamp_bad", F.lit("not-a-time"))
                      .when(d != "timestamp_absent", to_iso_text("event_ts")),
    }
    texts = _texts(b, fields, ORDER_FIELDS, d.isin("product_id_absent", "timestamp_absent"))
    text = F.col("_text")
    value = (F.when(d == "truncated", _half(text))
             .when(d == "quantity_text", F.regexp_replace(text, '"quantity":[0-9]+', '"quantity":"x"'))
             .when(d != "tombstone", text))
    return texts.withColumn("value", value.cast("binary"))


def pricing_rows(events: DataFrame) -> DataFrame:
    """What pricing-topic records are made from: one event per line."""
    kept = events.drop("l_quantity", "l_discount", "l_returnflag", "o_orderpriority", "c_mktsegment", "city", "region")
    return kept.withColumn("_copy", F.lit(1)).withColumn("partition", _partition(PRICING_TOPIC))


def pricing_values(rows: DataFrame) -> DataFrame:
    """``value`` of pricing-topic records. Suppliers map to competitors 0-5, of
    which 5 has no profile."""
    b = rows.withColumn("defect", _defect(PRICING_DEFECTS))
    d = F.col("defect")
    k = F.col("k")
    base = F.col("base_price")
    comp = r2(base * (F.lit(0.85) + F.floor(k / 4) % 21 / 100))
    our = F.when(d == "our_price_zero", F.lit(0.0)).otherwise(r2(base * (F.lit(0.90) + k % 17 / 100)))
    diff = r2(our - comp)
    fields = {
        "event_type": F.lit("price_update"),
        "product_id": F.col("product_id"),
        "product_name": F.col("product_name"),
        "category": F.col("category"),
        "brand": F.col("brand"),
        "competitor": F.concat(F.lit("COMP_"), (F.col("l_suppkey") % 6).cast("string")),
        "competitor_price": comp,
        "our_price": our,
        "price_diff": F.when(~d.isin("price_diff_absent", "price_diff_null"), diff),
        "price_diff_pct": r2(F.try_divide(diff, our) * 100),
        "in_stock": F.col("l_linestatus") == "F",
        "timestamp": to_iso_text("event_ts"),
    }
    texts = _texts(b, fields, PRICING_FIELDS, d == "price_diff_absent")
    return texts.withColumn("value", F.when(d == "truncated", _half(F.col("_text"))).otherwise(F.col("_text")).cast("binary"))


def other_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events of the ``events`` table on a topic no router knows."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.lit(None).cast("binary").alias("key"),
        to_json_value([F.col("event_id"), F.col("user_id"), F.col("event_type"), F.col("value"),
                       F.col("props")]).alias("value"),
        F.lit(OTHER_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").cast("bigint").alias("offset"),
        append_time(F.col("event_id")),
        F.lit(LOG_APPEND_TIME).alias("timestampType"),
    )


ROWS = {ORDERS_TOPIC: order_rows, PRICING_TOPIC: pricing_rows}
VALUE = {ORDERS_TOPIC: order_values, PRICING_TOPIC: pricing_values}


def topic_files(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_session_defaults(spark)
    return with_offsets(order_rows(event_rows(spark, sf_dir)), ORDERS_TOPIC, topic_files(spark))


def pricing_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_session_defaults(spark)
    return with_offsets(pricing_rows(event_rows(spark, sf_dir)), PRICING_TOPIC, topic_files(spark))


# publishing is memoised on disk; threads of one driver take turns
PUBLISH_LOCK = threading.RLock()


def fixture_root(spark: SparkSession, sf_dir: str) -> str:
    real = os.path.realpath(sf_dir)
    files = "|".join(f for t in BASE_TABLES for f in file_states(spark, table_path(sf_dir, t)))
    tag = hashlib.sha1(f"{real}|v{FIXTURE_VERSION}|{files}".encode()).hexdigest()[:12]
    return f"{work_root(spark)}/topics/{os.path.basename(real)}-{tag}"


def publish_topics(spark: SparkSession, sf_dir: str, files_per_topic: int | None = None,
                   force: bool = False, topics=TOPICS) -> str:
    """Write the topics (all three, or those named) as Kafka-shaped Parquet
    files (once per input; later calls reuse them). The big join runs once:
    its rows are staged as a table that both event topics are built from, so
    a lost executor costs a re-read, not a re-join. That table is laid out by order
    key, and so are the offsets: a task makes a file of a topic of a file of the table.
    Where the topic partitions do not advance alike along the keys, the rows are
    shuffled by offset. Each topic is range-laid-out by
    broker time, so time and offset ranges prune on min/max stats."""
    ensure_session_defaults(spark)
    with PUBLISH_LOCK:
        return _publish(spark, sf_dir, files_per_topic, force, topics)


def _publish(spark: SparkSession, sf_dir: str, files_per_topic: int | None, force: bool, topics) -> str:
    root = fixture_root(spark, sf_dir)
    n = files_per_topic or topic_files(spark)
    todo = [t for t in TOPICS if t in topics and (force or not path_exists(spark, f"{root}/{t}/_SUCCESS"))]
    staged = f"{root}/staging/events-{n}"
    if any(t in ROWS for t in todo) and (force or not path_exists(spark, f"{staged}/_SUCCESS")):
        with settings(spark, DEALT):
            compact(placed_rows(spark, sf_dir, n).write.mode("overwrite")).parquet(staged)
    for topic in todo:
        # by broker time, so that a reader of the files in order sees all
        # partitions advance together, as a consumer of the topic does
        if topic in ROWS:
            placed = spark.read.parquet(staged)
            recs = (placed_records(placed, topic) if advance_together(placed, topic)
                    else with_offsets(ROWS[topic](placed.withColumn("rank", F.col(_at(topic))).drop("_blk", "_r", *map(_at, ROWS))), topic, n))
        else:
            recs = (other_records(spark, sf_dir).repartitionByRange(n, "timestamp", "partition", "offset")
                    .sortWithinPartitions("timestamp", "partition", "offset"))
        with file_per_task(spark):
            compact(recs.write.mode("overwrite")).parquet(f"{root}/{topic}")
        order_files(spark, f"{root}/{topic}")
    return root


def order_files(spark: SparkSession, path: str) -> None:
    """Modification times one second apart in the order of the files' first broker
    times: a file stream reads files by modification time, and tasks finish (and take files) in any
    order."""
    fs, p = hadoop_fs(spark, path)
    first = {r.name: r.t.timestamp() for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("name"))
             .agg(F.min("timestamp").alias("t")).collect()}           # a row per file
    found = [st for st in fs.listStatus(p) if st.getPath().getName().startswith("part-")]
    found.sort(key=lambda st: (first.get(st.getPath().getName(), 0), st.getPath().getName()))
    if found:
        last = max(st.getModificationTime() for st in found)
        for k, st in enumerate(found):
            fs.setTimes(st.getPath(), last - (len(found) - k) * 1000, -1)
