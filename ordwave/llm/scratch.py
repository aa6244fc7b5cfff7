"""Intermediate tables in the cluster's shared folder.

The folder is ``spark.checkpoint.dir`` of the session. It is only chosen here
when unset and the master is local (tests); otherwise that is an error,
because executors could not read each other's files.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUN = uuid.uuid4().hex[:12]
_USED: dict[str, SparkSession] = {}


def root(spark: SparkSession) -> str:
    """URI of this driver's folder below the shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="ordwave-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    if "://" not in base and not base.startswith("file:"):
        base = "file://" + base
    path = f"{base.rstrip('/')}/ordwave-llm/{_RUN}"
    if path not in _USED:
        _USED[path] = spark
        atexit.register(drop, spark, path)
    return path


def folder(spark: SparkSession, name: str) -> str:
    """A new, unused folder URI."""
    return f"{root(spark)}/{name}-{uuid.uuid4().hex[:10]}"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, fixes non-deterministic ids and gives the planner a real size."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder (best effort at exit, when the JVM may be gone)."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the session is already closed
        return


def drop_table(df: DataFrame) -> None:
    """Delete the files behind a table made by :func:`table`."""
    files = df.inputFiles()
    if files:
        drop(df.sparkSession, files[0].rsplit("/", 1)[0])


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, also
    when the session was started in another folder."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in parts:
        env["PYTHONPATH"] = os.pathsep.join([home, *parts])
