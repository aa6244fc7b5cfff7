"""Deterministic weighted bucketing.

A key is hashed to a 32-bit number u (the first 8 hex digits of
``md5(salt || key)``), and the weights cut [0, 2^32) into contiguous ranges,
one per option, at exact cumulative thresholds. To look u up without a range
join, each option is listed once for every coarse slot (u's top 16 bits) that
its range touches: an equi-join on the slot, then ``lo <= u < hi``. The
listing has one row per option plus one per slot, so a small dimension is
broadcast by the planner and a large one is shuffled with the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = 1 << 32
SLOT_BITS = 16
BLOCK = 4096


def hash32(salt: str, key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), k.cast("string"))), 1, 8), 16, 10).cast("bigint")


def cumulative(weights: DataFrame, weight: str, order: str, block: str | None = None) -> DataFrame:
    """``_hi``: running sum of the weights in ``order``. With ``block``, an
    integer column that never decreases along the order, blocks are summed
    first, so no window sees more than one block or the blocks' sums."""
    before = Window.unboundedPreceding
    if block is None:
        return weights.withColumn("_hi", F.sum(weight).over(Window.orderBy(order).rowsBetween(before, 0)))
    w = weights.withColumn("_blk", F.floor(F.col(block) / BLOCK))
    base = (w.groupBy("_blk").agg(F.sum(weight).alias("_n"))
            .withColumn("_base", F.coalesce(F.sum("_n").over(Window.orderBy("_blk").rowsBetween(before, -1)), F.lit(0))).drop("_n"))
    run = F.sum(weight).over(Window.partitionBy("_blk").orderBy(order).rowsBetween(before, 0))
    return w.join(base, "_blk").withColumn("_hi", run + F.col("_base")).drop("_blk", "_base")


def ranges(weights: DataFrame, option: str, weight: str = "weight", order: str | None = None, block: str | None = None) -> DataFrame:
    """``option, lo, hi``: the range of u of each option, exact in integers;
    every option with a positive weight of at least total / 2^32 has one."""
    c = cumulative(weights.where(F.col(weight) > 0), weight, order or option, block)
    total = weights.agg(F.sum(weight)).scalar()
    wide = lambda x: F.floor(x.cast("decimal(28,0)") * SPACE / total.cast("decimal(20,0)")).cast("bigint")
    return c.select(option, wide(F.col("_hi") - F.col(weight)).alias("lo"), wide(F.col("_hi")).alias("hi")).where("hi > lo")


def assign(df: DataFrame, key: str, salt: str, options: DataFrame, out: str) -> DataFrame:
    """``df`` with the option (column ``out``) of each key's u; NULL keys get
    none. ``options`` comes from :func:`ranges`."""
    opt = [c for c in options.columns if c not in ("lo", "hi")][0]
    shift = 32 - SLOT_BITS
    listed = options.select(F.col(opt).alias(out), "lo", "hi", F.explode(F.sequence(
        F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift))).alias("_slot"))
    u = df.withColumn("_u", hash32(salt, key)).withColumn("_slot", F.shiftright("_u", shift))
    hit = (u["_slot"] == listed["_slot"]) & (u["_u"] >= listed["lo"]) & (u["_u"] < listed["hi"])
    return u.join(listed, hit, "left").drop(listed["_slot"]).drop("lo", "hi", "_u", "_slot")
