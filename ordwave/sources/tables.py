"""Batch scans of tables."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One base table; column pruning and filters reach the Parquet scan."""
    return spark.read.parquet(table_path(sf_dir, name))


def compact(writer: DataFrameWriter, fmt: str = "parquet") -> DataFrameWriter:
    """Parquet files of event rows: text of few words and near numbers, of which
    Zstandard leaves about half of what Spark's default codec does."""
    return writer.option("compression", "zstd") if fmt == "parquet" else writer


@contextmanager
def settings(spark: SparkSession, values: dict):
    """Session settings for the queries of a block; then they are as before."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def unsorted_partitions(spark: SparkSession, values: int):
    """Writes partitioned by a column of at most ``values`` values: each task keeps
    a file of each open, instead of sorting its rows by that column first."""
    return settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(values)})


def file_per_task(spark: SparkSession):
    """Scans of which a task reads one file (or a part of a large one), not several small ones."""
    return settings(spark, {"spark.sql.files.openCostInBytes": spark.conf.get("spark.sql.files.maxPartitionBytes")})


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) of ``path`` through the session's JVM gateway, or
    None without one (Spark Connect)."""
    try:
        sc = spark.sparkContext
        jvm = sc._jvm
    except Exception:  # noqa: BLE001 - no classic gateway
        return None
    if jvm is None:
        return None
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(sc._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does a file or directory exist at ``path``? One ``exists`` call on
    the path's Hadoop file system (HDFS, object stores, local): O(1), no
    listing of what lies below. Without a JVM gateway (Spark Connect) it
    falls back to resolving a reader on the path."""
    fs = hadoop_fs(spark, path)
    if fs is not None:
        return bool(fs[0].exists(fs[1]))
    try:
        spark.read.format("binaryFile").load(path).schema  # noqa: B018
        return True
    except AnalysisException:
        return False


def file_states(spark: SparkSession, path: str) -> list:
    """Path, length and modification time of a table's files: what a cached
    derivation of the table depends on."""
    fs = hadoop_fs(spark, path)
    if fs is None:
        raise RuntimeError("a JVM gateway is needed to look at a table's files")
    if not fs[0].exists(fs[1]):
        return [f"{path}:missing"]
    found = fs[0].listStatus(fs[1])       # of a file, the file itself
    return sorted(f"{st.getPath().toString()}:{st.getLen()}:{st.getModificationTime()}" for st in found)
