"""Deduplication (G1, batch form).

Most keys come once, and their rows stay where they are read: only hashes of
the keys are shuffled to find those that come again, which mark bitmaps of a fixed
size. Rows that the bitmaps let through (all of those, and few others) go on to
``row_number() = 1`` per key: Spark keeps one row per key in each map task
before the shuffle (a partial group limit), so a replayed key costs one row
per task however often it was sent. Rows without a key (NULL or blank) are
different orders, not one: they are only merged when every column is equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


BLOCK = 32_768           # slots of a bitmap
BLOCKS = 1 << 14         # bitmaps: 2^29 slots (64 MB); with more keys that come again more others are shuffled


def bit(bits: Column, position: Column) -> Column:
    """The bit of a bitmap (as ``bitmap_construct_agg`` numbers them)."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def has_key(key: str) -> Column:
    """A key that identifies its row: neither NULL nor blank."""
    return F.coalesce(F.trim(F.col(key).cast("string")) != "", F.lit(False))


def repeated(df: DataFrame, key: str) -> DataFrame:
    """Bitmaps (``_block``, ``_bits``) of the slots of keys that come more than once."""
    hashes = df.where(has_key(key)).select(F.xxhash64(F.col(key)).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    slot = hashes.where("_n > 1").select(F.pmod("_h", F.lit(BLOCKS * BLOCK)).alias("_slot"))
    # bitmap functions number from 1: slot s is position s % BLOCK of bitmap s / BLOCK
    return slot.groupBy(F.floor(F.col("_slot") / BLOCK).alias("_block")).agg(F.bitmap_construct_agg(F.col("_slot") % BLOCK).alias("_bits"))


def first_per_key(df: DataFrame, key: str, order_cols: list) -> DataFrame:
    """One row per ``key``: the smallest by ``order_cols`` (NULLs first, then
    every other column as tie-break, so the choice is deterministic). Rows
    without a key: one per distinct row. ``df`` is read three times (its keys, rows that
    come once, and the others), so it should be a table or near to one."""
    rest = [c for c in df.columns if c != key and c not in order_cols]
    order = [F.col(c).asc_nulls_first() for c in order_cols + rest]
    whole_row = F.when(~has_key(key), F.struct(*df.columns))
    w = Window.partitionBy(F.col(key), whole_row).orderBy(*order)
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(BLOCKS * BLOCK))
    marked = (df.withColumn("_block", F.floor(slot / BLOCK)).join(F.broadcast(repeated(df, key)), "_block", "left")       # at most BLOCKS rows
              .withColumn("_again", ~has_key(key) | F.coalesce(bit(F.col("_bits"), slot % BLOCK), F.lit(False))).drop("_block", "_bits"))
    once = marked.where("NOT _again").select(*df.columns)
    again = marked.where("_again").select(*df.columns)
    return once.unionByName(again.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn"))
