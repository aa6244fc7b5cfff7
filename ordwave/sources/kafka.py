"""Stream and batch scans of topics.

Live: Spark's Kafka source. Offline (tests, bounded backfills): a file
stream of Parquet files carrying the Kafka record schema, so everything
downstream of the scan is the same plan either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import IngestConfig, kafka_source_options
from ..schemas import KAFKA_RECORD


def kafka_stream(spark: SparkSession, cfg: IngestConfig, topics) -> DataFrame:
    """Subscribe to one or several topics. Needs the Kafka
    connector on the classpath (``build_session(kafka=True)``)."""
    reader = spark.readStream.format("kafka")
    for k, v in kafka_source_options(cfg, topics).items():
        reader = reader.option(k, v)
    return reader.load()


def kafka_batch(spark: SparkSession, cfg: IngestConfig, topics, ending: str = "latest") -> DataFrame:
    """S9 against a live broker: a bounded read of the retained log."""
    reader = spark.read.format("kafka")
    opts = kafka_source_options(cfg.with_(starting_offsets="earliest"), topics)
    opts.pop("maxOffsetsPerTrigger", None)
    opts["endingOffsets"] = ending
    for k, v in opts.items():
        reader = reader.option(k, v)
    return reader.load()


def record_files_stream(spark: SparkSession, paths, max_files_per_trigger: int | None = None,
                        max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Kafka-shaped record files as a stream (file form of S1/S2/S5).
    Each micro-batch is bounded by bytes or by files (T5); bytes win, as
    Spark takes one of the two."""
    if isinstance(paths, str):
        paths = [paths]
    reader = spark.readStream.schema(KAFKA_RECORD)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    elif max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if len(paths) == 1:
        return reader.parquet(paths[0])
    out = None
    for p in paths:
        s = reader.parquet(p)
        out = s if out is None else out.unionByName(s)
    return out


def record_files(spark: SparkSession, paths) -> DataFrame:
    """The same records as a bounded batch scan."""
    if isinstance(paths, str):
        paths = [paths]
    return spark.read.schema(KAFKA_RECORD).parquet(*paths)


def route(records: DataFrame, topic: str, drop_tombstones: bool = False) -> DataFrame:
    """one topic out of a multi-topic scan; optionally drop
    tombstones (NULL values). Unknown topics never match any route."""
    out = records.where(F.col("topic") == topic)
    if drop_tombstones:
        out = out.where(F.col("value").isNotNull())
    return out
