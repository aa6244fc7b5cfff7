"""An index of the keys a stream has landed (G1 without a watermark).

Rows whose key was landed before, however long ago, are dropped; none is lost
for being late. Per micro-batch the keys landed are written to
``<home>/keys/r=<N>-<N>`` (hash bucket and key, sorted, so a filter on the bucket
skips row groups), and a Bloom filter of them, as bitmaps of 32,768 slots, to
``<home>/blooms/r=<N>-<N>``. A batch is probed in two steps: its keys against the
bitmaps, which few keys pass that are new; those that do against the index,
of which only their buckets are read, with a left-anti join.

Of ``TIER`` neighbouring ranges of the same magnitude one is made
(``r=<first>-<last>``), so a key is rewritten once per power of ``TIER`` batches
and a probe reads a few ranges. Readers take the widest complete ranges; those
inside them are deleted by a later merge. A replayed batch does not see its own
range and overwrites it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import bit
from ..sources.snapshots import folder_names, delete
from ..sources.tables import path_exists

BUCKETS = 4096
BLOCK = 32_768           # slots of a bitmap
BLOCKS = 1 << 14         # bitmaps: 2^29 slots (64 MB); with more keys more of them are looked up in the index
HASHES = 2
TIER = 8
KEYS = "bucket int, key string"
BLOOMS = "block bigint, bits binary"


def bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def slots(key: Column) -> Column:
    return F.array(*(F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCKS * BLOCK)) for i in range(1, HASHES + 1)))


def _level(r: tuple) -> int:
    """Power of ``TIER`` in the length of a range."""
    n, level = r[1] - r[0] + 1, 0
    while n >= TIER:
        n, level = n // TIER, level + 1
    return level


class IdIndex:
    def __init__(self, home: str):
        self.home = home.rstrip("/")

    def _path(self, kind: str, lo: int, hi: int) -> str:
        return f"{self.home}/{kind}/r={lo:012d}-{hi:012d}"

    def ranges(self, spark: SparkSession) -> list:
        """All complete ranges (lo, hi); a range is complete when its keys and
        its bitmaps are."""
        names = set(folder_names(spark, f"{self.home}/keys")) & set(folder_names(spark, f"{self.home}/blooms"))
        found = sorted(tuple(map(int, n[2:].split("-"))) for n in names if n.startswith("r="))
        return [r for r in found if all(path_exists(spark, f"{self._path(k, *r)}/_SUCCESS") for k in ("keys", "blooms"))]

    @staticmethod
    def widest(ranges: list) -> list:
        return [r for r in ranges if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in ranges)]

    def _read(self, spark: SparkSession, kind: str, ranges) -> DataFrame:
        return spark.read.schema(KEYS if kind == "keys" else BLOOMS).parquet(*(self._path(kind, *r) for r in ranges))

    def seen(self, keys: DataFrame, batch_id: int) -> DataFrame | None:
        """Those of the keys (column ``key``; they may repeat) that earlier batches have landed;
        None if the bitmaps rule all of them out. The bitmaps, of a fixed size, are
        broadcast: only keys that pass them are shuffled."""
        spark = keys.sparkSession
        ranges = [r for r in self.widest(self.ranges(spark)) if r[1] < batch_id]
        if not ranges:
            return None
        slot = keys.select("key", F.posexplode(slots(F.col("key"))).alias("i", "slot"))
        slot = slot.select("key", "i", F.floor(F.col("slot") / BLOCK).alias("block"), (F.col("slot") % BLOCK).alias("at"))
        blooms = self._read(spark, "blooms", ranges)
        if len(ranges) > 1:
            blooms = blooms.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
        hit = slot.join(F.broadcast(blooms), "block").where(bit(F.col("bits"), F.col("at")))      # at most BLOCKS rows
        suspect = hit.groupBy("key").agg(F.count_distinct("i").alias("n")).where(F.col("n") == HASHES).select("key").persist()
        try:
            buckets = [r.b for r in suspect.select(bucket(F.col("key")).alias("b")).distinct().collect()]        # at most BUCKETS
            if not buckets:
                return None
            index = self._read(spark, "keys", ranges).where(F.col("bucket").isin(buckets)).select("key")
            out = suspect.join(index, "key", "left_semi").distinct()
            found = f"{self.home}/seen"
            out.write.mode("overwrite").parquet(found)
        finally:
            suspect.unpersist()
        return spark.read.schema("key string").parquet(found)

    def add(self, keys: DataFrame, batch_id: int) -> None:
        """Record the keys that a batch landed; a replay overwrites them."""
        spark = keys.sparkSession
        path = self._path("keys", batch_id, batch_id)
        keys.select(bucket(F.col("key")).alias("bucket"), "key").sortWithinPartitions("bucket", "key").write.mode("overwrite").option("compression", "zstd").parquet(path)
        slot = spark.read.schema(KEYS).parquet(path).select(F.explode(slots(F.col("key"))).alias("slot"))
        # bitmap functions number from 1: slot s is position s % BLOCK of bitmap s / BLOCK
        (slot.groupBy(F.floor(F.col("slot") / BLOCK).alias("block")).agg(F.bitmap_construct_agg(F.col("slot") % BLOCK).alias("bits"))
         .write.mode("overwrite").parquet(self._path("blooms", batch_id, batch_id)))

    def merge(self, spark: SparkSession, before: int) -> list:
        """Make one range of ``TIER`` neighbours of the same magnitude, for batches
        before ``before`` (which are committed); delete ranges that earlier
        merges left inside wider ones."""
        every = self.ranges(spark)
        use = [r for r in self.widest(every) if r[1] < before]
        for r in every:
            if r[1] < before and r not in use:
                for kind in ("keys", "blooms"):
                    delete(spark, self._path(kind, *r))
        made = []
        while True:
            last = use[-TIER:]
            if len(last) < TIER or len({_level(r) for r in last}) > 1:
                return made
            lo, hi = last[0][0], last[-1][1]
            self._read(spark, "keys", last).repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key").write.mode("overwrite").option("compression", "zstd").parquet(self._path("keys", lo, hi))
            self._read(spark, "blooms", last).groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits")).write.mode("overwrite").parquet(self._path("blooms", lo, hi))
            use[-TIER:] = [(lo, hi)]
            made.append((lo, hi))
