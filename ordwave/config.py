"""Configuration, Kafka option maps and the session helper.

One frozen config object replaces the scattered environment reads of a
consumer and a producer: the same option builder serves the Kafka source
and the Kafka sink, so security settings cannot drift between them.
"""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

from .schemas import ORDERS_TOPIC, PRICING_TOPIC


@dataclass(frozen=True)
class IngestConfig:
    kafka_bootstrap: str = "localhost:9092"
    orders_topic: str = ORDERS_TOPIC
    pricing_topic: str = PRICING_TOPIC
    # first start only; afterwards the checkpoint decides
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    trigger_seconds: int = 15
    # bounds one micro-batch (Kafka), about 5 GB of events of this contract
    max_offsets_per_trigger: int | None = 10_000_000
    # bounds one micro-batch (file form of the topics)
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: int | None = None
    min_partitions: int | None = None
    # state-store partitions of stateful queries; None = cluster parallelism
    state_partitions: int | None = None
    # state store of stateful queries: RocksDB keeps large state off the JVM
    # heap; "hdfs" = Spark's default in-memory provider
    state_store: str = "rocksdb"
    # output and checkpoint roots; None = derived from spark.checkpoint.dir
    sink_root: str | None = None
    checkpoint_root: str | None = None
    # SASL_SSL/PLAIN credentials; from the environment only
    api_key: str | None = field(default=None, repr=False)
    api_secret: str | None = field(default=None, repr=False)
    validator: str = "nulls"  # or "strict"
    quarantine_pricing: bool = False
    drop_tombstones: bool = False   # tombstones reach no output
    stop_marker: str | None = None  # streams end between micro-batches once this path exists
    unique_orders: bool = False     # also land each order's first arrival (``orders_unique``)

    def __post_init__(self):
        if self.validator not in ("nulls", "strict"):
            raise ValueError(f"validator must be 'nulls' or 'strict', not {self.validator!r}")
        if self.state_store not in ("rocksdb", "hdfs"):
            raise ValueError(f"state_store must be 'rocksdb' or 'hdfs', not {self.state_store!r}")
        if self.starting_offsets not in ("latest", "earliest") and not self.starting_offsets.startswith("{"):
            raise ValueError("starting_offsets must be 'latest', 'earliest' or a JSON offset map")
        for name in ("trigger_seconds", "max_offsets_per_trigger", "max_files_per_trigger", "max_bytes_per_trigger", "min_partitions",
                     "state_partitions"):
            v = getattr(self, name)
            if v is not None and v <= 0:
                raise ValueError(f"{name} must be positive, not {v}")

    def with_(self, **kw) -> "IngestConfig":
        return replace(self, **kw)


def config_from_env(env: dict | None = None, **overrides) -> IngestConfig:
    """Read the deployment settings from the environment."""
    env = os.environ if env is None else env
    kw = {}
    bootstrap = env.get("KAFKA_BOOTSTRAP") or env.get("KAFKA_BOOTSTRAP_SERVER")
    if bootstrap:
        kw["kafka_bootstrap"] = bootstrap
    if env.get("CHECKPOINT_DIR"):
        kw["checkpoint_root"] = env["CHECKPOINT_DIR"]
    if env.get("SINK_ROOT"):
        kw["sink_root"] = env["SINK_ROOT"]
    if env.get("KAFKA_API_KEY") and env.get("KAFKA_API_SECRET"):
        kw["api_key"] = env["KAFKA_API_KEY"]
        kw["api_secret"] = env["KAFKA_API_SECRET"]
    kw.update(overrides)
    return IngestConfig(**kw)


def _security_options(cfg: IngestConfig) -> dict:
    if not (cfg.api_key and cfg.api_secret):
        return {}
    jaas = (
        "org.apache.kafka.common.security.plain.PlainLoginModule required "
        f'username="{cfg.api_key}" password="{cfg.api_secret}";'
    )
    return {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": jaas,
    }


def kafka_source_options(cfg: IngestConfig, topics) -> dict:
    """Options for ``spark.readStream.format("kafka")``."""
    if isinstance(topics, str):
        topics = [topics]
    opts = {
        "kafka.bootstrap.servers": cfg.kafka_bootstrap,
        "subscribe": ",".join(topics),
        "startingOffsets": cfg.starting_offsets,
        "failOnDataLoss": str(cfg.fail_on_data_loss).lower(),
    }
    if cfg.max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(cfg.max_offsets_per_trigger)
    if cfg.min_partitions:
        opts["minPartitions"] = str(cfg.min_partitions)
    opts.update(_security_options(cfg))
    return opts


def kafka_sink_options(cfg: IngestConfig, topic: str | None = None) -> dict:
    """Options for ``df.write(Stream).format("kafka")`` (K4)."""
    opts = {"kafka.bootstrap.servers": cfg.kafka_bootstrap}
    if topic:
        opts["topic"] = topic
    opts.update(_security_options(cfg))
    return opts


SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.metricsEnabled": "true",
}


def build_session(app_name: str = "ordwave", master: str | None = None, kafka: bool = False,
                  conf: dict | None = None) -> SparkSession:
    """Session helper (S10). The master is never hard-coded: it comes from
    the caller or from spark-submit. The Kafka connector is resolved only
    when asked for, at the version of the running PySpark."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in {**SESSION_DEFAULTS, **(conf or {})}.items():
        b = b.config(k, v)
    if kafka:
        import pyspark

        b = b.config("spark.jars.packages",
                     f"org.apache.spark:spark-sql-kafka-0-10_2.13:{pyspark.__version__}")
    return b.getOrCreate()


def ensure_session_defaults(spark: SparkSession) -> None:
    """Timestamps without offset are UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def work_root(spark: SparkSession) -> str:
    """Shared folder for materialised tables, sinks and stream checkpoints.

    Taken from the cluster's ``spark.checkpoint.dir``. Unset, a private
    temporary folder is made on a local master only; elsewhere that is an
    error, because executors could not read each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ordwave-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/") + "/ordwave"
