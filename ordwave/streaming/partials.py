"""Partial aggregates kept per landed batch (A1-A3, S4 over time).

Beside each batch of a landed table its lander writes a few rows to
``<root>/partials/<table>/batch=<name>``, read off the files just written:

* ``day``: rows, first and last time of each status and day;
* ``offsets``: per topic partition and bitmap of 32,768 offsets, which were
  seen. A bitmap that is full is dropped, so only the ends of the log, and the
  bitmaps with a gap, hold bytes.

A replayed batch overwrites its rows. From time to time the rows of all
committed batches are merged into ``through=<last batch id>``, so reports over
the life of a table read one folder and the few batches since, never the
events. Folded rows are deleted by the next fold, when no report planned before
it should be running any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import to_ntz
from ..operators.dedup import bit
from ..operators.dims import literal_rows
from ..sources.snapshots import folder_names, batch_files, delete, stream_id
from ..sources.tables import path_exists

PARTIALS = ("kind string, status string, d date, topic string, partition int, bucket bigint, n bigint, lo bigint, hi bigint, "
            "first timestamp_ntz, last timestamp_ntz, bits binary, full boolean")
KEYS = ["kind", "status", "d", "topic", "partition", "bucket"]
BITMAP = 32_768          # offsets of a bitmap
FOLD_EVERY = 64          # batches


def _home(root: str, table: str) -> str:
    return f"{root}/partials/{table}"


def _null(name: str, type_: str):
    return F.lit(None).cast(type_).alias(name)


def _fields(df: DataFrame) -> DataFrame:
    """All columns of ``PARTIALS``, those missing as NULL."""
    cols = [c.strip().split(" ") for c in PARTIALS.split(",")]
    return df.select(*(F.col(n).cast(t).alias(n) if n in df.columns else _null(n, t) for n, t in cols))


def of_batch(rows: DataFrame) -> DataFrame:
    """The partial rows of a batch's files (good and bad rows)."""
    good = F.col("status") == "good"
    t = F.when(good, F.col("timestamp")).otherwise(to_ntz("kafka_timestamp"))
    days = (rows.select("status", t.alias("t")).groupBy("status", F.to_date("t").alias("d"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first"), F.max("t").alias("last")).withColumn("kind", F.lit("day")))
    seen = (rows.groupBy("topic", "partition", F.bitmap_bucket_number("offset").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi"),
                 F.bitmap_construct_agg(F.bitmap_bit_position("offset")).alias("bits")).withColumn("kind", F.lit("offsets")))
    return _fields(days).unionByName(_fields(_without_full(seen)))


def _without_full(df: DataFrame) -> DataFrame:
    full = F.coalesce(F.col("full"), F.lit(False)) if "full" in df.columns else F.lit(False)
    full = full | F.coalesce(F.bitmap_count("bits") == BITMAP, F.lit(False))
    return df.withColumn("full", full).withColumn("bits", F.when(~F.col("full"), F.col("bits")))


def merge(parts: DataFrame) -> DataFrame:
    """One row per key: counts add up, times and offsets widen, bitmaps are united."""
    merged = parts.groupBy(*KEYS).agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.bitmap_or_agg("bits").alias("bits"), F.bool_or("full").alias("full"))
    offsets = F.col("kind") == "offsets"
    merged = _without_full(merged.withColumn("bits", F.when(offsets, F.col("bits"))))
    return _fields(merged.withColumn("full", F.when(offsets, F.col("full"))))


def write_partials(spark: SparkSession, root: str, table: str, batch: str) -> None:
    rows = batch_files(spark, root, table, f"{root}/{table}/batch={batch}")
    of_batch(rows).coalesce(1).write.mode("overwrite").parquet(f"{_home(root, table)}/batch={batch}")


def write_coordinates(rows: DataFrame, path: str) -> None:
    """Which offsets of each topic partition the rows have, as bitmaps (4 KB for
    32,768 offsets)."""
    (rows.groupBy("topic", "partition", F.bitmap_bucket_number("offset").alias("bucket"))
     .agg(F.bitmap_construct_agg(F.bitmap_bit_position("offset")).alias("bits")).write.parquet(path))


def records_at(records: DataFrame, path: str) -> DataFrame:
    """The records whose coordinates were written: the log is filtered where it
    is read, its values are not shuffled."""
    seen = F.broadcast(records.sparkSession.read.schema("topic string, partition int, bucket bigint, bits binary").parquet(path))
    hit = (records.withColumn("bucket", F.bitmap_bucket_number("offset")).join(seen, ["topic", "partition", "bucket"])
           .where(bit(F.col("bits"), F.bitmap_bit_position("offset"))))
    return hit.select(*records.columns)


def _layout(spark: SparkSession, root: str, table: str) -> tuple:
    """(last folded id or -1, its older folds, batch names)."""
    names = folder_names(spark, _home(root, table))
    folds = sorted(int(n.removeprefix("through=")) for n in names if n.startswith("through="))
    folds = [i for i in folds if path_exists(spark, f"{_home(root, table)}/through={i:012d}/_SUCCESS")]
    return (folds[-1] if folds else -1), folds[:-1], sorted(n.removeprefix("batch=") for n in names if n.startswith("batch="))


def _later(batches, through: int) -> list:
    """Bounded loads, and the stream batches after a fold."""
    return [b for b in batches if stream_id(b) is None or stream_id(b) > through]


def read_partials(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The newest fold and the batches since: a few rows per day and bitmap."""
    through, _, batches = _layout(spark, root, table)
    home = _home(root, table)
    paths = [f"{home}/batch={b}" for b in _later(batches, through)] + ([f"{home}/through={through:012d}"] if through >= 0 else [])
    return spark.read.schema(PARTIALS).parquet(*paths) if paths else spark.createDataFrame([], PARTIALS)


def fold_partials(spark: SparkSession, root: str, table: str, upto: int) -> bool:
    """Merge the partial rows of all stream batches up to ``upto`` (which must be
    committed); delete what the fold before had merged."""
    through, older, batches = _layout(spark, root, table)
    home = _home(root, table)
    fold = [b for b in batches if stream_id(b) is not None and through < stream_id(b) <= upto]
    if not fold:
        return False
    paths = [f"{home}/batch={b}" for b in fold] + ([f"{home}/through={through:012d}"] if through >= 0 else [])
    merge(spark.read.schema(PARTIALS).parquet(*paths)).write.mode("overwrite").parquet(f"{home}/through={upto:012d}")
    for b in batches:
        if stream_id(b) is not None and stream_id(b) <= through:
            delete(spark, f"{home}/batch={b}")
    for i in older:
        delete(spark, f"{home}/through={i:012d}")
    return True


def stored_rows_per_day(parts: DataFrame, status: str = "good") -> DataFrame:
    """A3 without the events: rows per calendar day, ascending."""
    return (parts.where((F.col("kind") == "day") & (F.col("status") == status)).groupBy("d").agg(F.sum("n").alias("n")).orderBy("d"))


def stored_summary(spark: SparkSession, root: str, tables) -> DataFrame:
    """S8 + A1 + A2 without the events: a row for each table and its quarantine;
    ``missing`` where no row has arrived."""
    out = None
    for table in tables:
        parts = read_partials(spark, root, table)
        got = parts.where("kind = 'day'").groupBy("status").agg(
            F.sum("n").alias("n"), F.min("first").alias("mn"), F.max("last").alias("mx"), F.count_distinct("d").alias("n_days"))
        names = literal_rows(spark, [(table, "good"), (f"{table}_quarantine", "bad")], [("table_name", "string"), ("status", "string")])
        row = names.join(got, "status", "left").select(
            "table_name", F.when(F.col("n").isNull(), "missing").otherwise("ok").alias("status"), "n", "mn", "mx", "n_days")
        out = row if out is None else out.unionByName(row)
    return out


def stored_offset_gaps(parts: DataFrame) -> DataFrame:
    """S4 over the life of a stream: offsets never seen inside the range of
    each topic partition. Bitmaps of several batches are united; those without
    any offset count as missing by the range."""
    seen = merge(parts.where("kind = 'offsets'"))
    distinct = F.when(F.col("full"), F.lit(BITMAP)).otherwise(F.bitmap_count("bits"))
    return (seen.groupBy("topic", "partition")
            .agg(F.min("lo").alias("min_offset"), F.max("hi").alias("max_offset"), F.sum("n").alias("n"), F.sum(distinct).alias("n_distinct"))
            .withColumn("missing", F.col("max_offset") - F.col("min_offset") + 1 - F.col("n_distinct")))
