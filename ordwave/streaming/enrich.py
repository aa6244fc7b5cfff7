"""Orders landed with the product attributes of their time (J4 on the stream).

A dimension is kept as numbered versions, ``<home>/v=<N>``. The version that a
micro-batch joins is the newest at its first attempt and is recorded before
the join, so a batch that is replayed after the dimension has changed gives the
same rows. The join is by key; the version's size is known to the planner,
which broadcasts it while it is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dims import with_product
from ..operators.transform import LANDED_COLUMNS
from ..sources.snapshots import batch_files, folder_names
from ..sources.tables import compact, hadoop_fs, path_exists
from .sinks import BatchLander, batch_path

PINS = 1000              # batches whose versions are recorded in one folder


class VersionedDim:
    def __init__(self, home: str):
        self.home = home.rstrip("/")

    def versions(self, spark: SparkSession) -> list:
        """Complete versions, ascending."""
        found = sorted(int(n[2:]) for n in folder_names(spark, self.home) if n.startswith("v="))
        return [v for v in found if path_exists(spark, f"{self.home}/v={v:012d}/_SUCCESS")]

    def publish(self, df: DataFrame) -> int:
        """Write the next version; streams take it with their next new batch."""
        known = folder_names(df.sparkSession, self.home)
        version = 1 + max((int(n[2:]) for n in known if n.startswith("v=")), default=-1)
        df.write.parquet(f"{self.home}/v={version:012d}")
        return version

    def read(self, spark: SparkSession, version: int) -> DataFrame:
        return spark.read.parquet(f"{self.home}/v={version:012d}")

    def pinned(self, spark: SparkSession, pins: str, batch_id: int) -> int:
        """The version of a batch: the one on record, else the newest, put on record."""
        folder = f"{pins}/{batch_id // PINS:06d}"
        mark = f"batch={batch_id}-v="
        for name in folder_names(spark, folder):
            if name.startswith(mark):
                return int(name.removeprefix(mark))
        known = self.versions(spark)
        if not known:
            raise ValueError(f"{self.home} has no version: publish the dimension first")
        fs, path = hadoop_fs(spark, f"{folder}/{mark}{known[-1]}")
        fs.mkdirs(path.getParent())
        fs.createNewFile(path)
        return known[-1]


class EnrichedLander(BatchLander):
    """A lander that also writes ``<table>_enriched``: the good rows with the
    attributes ``cols`` of their product (``dim_<name>``, NULL if unknown) and the
    version they are of."""

    def __init__(self, *args, dim: VersionedDim, cols=("base_price",), **kw):
        super().__init__(*args, **kw)
        self.dim, self.cols = dim, cols

    def after(self, spark: SparkSession, batch_id: int) -> None:
        super().after(spark, batch_id)
        version = self.dim.pinned(spark, f"{self.out_root}/pins/{self.table}", batch_id)
        good = batch_files(spark, self.out_root, self.table, batch_path(self.out_root, self.table, batch_id)).where("status = 'good'")
        rows = with_product(good.select(*LANDED_COLUMNS[self.table]), self.dim.read(spark, version), self.cols)
        compact(rows.withColumn("dim_version", F.lit(version).cast("bigint")).write.mode("overwrite")).parquet(
            batch_path(self.out_root, f"{self.table}_enriched", batch_id))


def read_enriched(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{table}_enriched").drop("batch")
