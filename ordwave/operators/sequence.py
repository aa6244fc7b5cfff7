"""Dense numbering within a group, without one task per group.

``row_number() over (partition by g order by ...)`` sends a whole group to
one task; with few groups (Kafka partitions, topics) one group can hold a
third of all rows. Here the order's leading integer column is cut into
blocks; each block is numbered by its own small window, and block start
positions come from prefix sums over block counts, computed in two
levels (blocks, then blocks of blocks) so no window ever sees more than
one super-block of count rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def block_starts(df: DataFrame, group_col: str, block: int) -> DataFrame:
    """``group_col, _blk, _base``: how many rows of the group are in blocks before
    (``df`` has the column ``_blk``)."""
    counts = (df.groupBy(group_col, "_blk").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_sup", F.floor(F.col("_blk") / block)))
    sup_counts = counts.groupBy(group_col, "_sup").agg(F.sum("_n").alias("_n2"))
    before = Window.unboundedPreceding
    w_sup = Window.partitionBy(group_col).orderBy("_sup").rowsBetween(before, -1)
    sup_base = sup_counts.select(group_col, "_sup",
                                 F.coalesce(F.sum("_n2").over(w_sup), F.lit(0)).alias("_base2"))
    w_blk = Window.partitionBy(group_col, "_sup").orderBy("_blk").rowsBetween(before, -1)
    return (counts.select(group_col, "_sup", "_blk",
                          F.coalesce(F.sum("_n").over(w_blk), F.lit(0)).alias("_base1"))
            .join(sup_base, [group_col, "_sup"])
            .select(group_col, "_blk", (F.col("_base1") + F.col("_base2")).alias("_base")))


def dense_sequence(df: DataFrame, group_col: str, order_cols: list, coarse_col: str,
                   block: int = 1024, out: str = "seq") -> DataFrame:
    """Add ``out`` = 0-based position of each row within ``group_col`` in the
    order ``order_cols``. ``coarse_col`` is an integer column that never
    decreases along that order (normally its first column)."""
    d = df.withColumn("_blk", F.floor(F.col(coarse_col) / block))
    w_row = Window.partitionBy(group_col, "_blk").orderBy(*order_cols)
    return (d.join(block_starts(d, group_col, block), [group_col, "_blk"])
            .withColumn(out, (F.col("_base") + F.row_number().over(w_row) - 1).cast("bigint"))
            .select(*df.columns, out))


BLOCKS = 1 << 15


def block_width(df: DataFrame, coarse_col: str) -> int:
    """Width of blocks of an integer column, about ``BLOCKS`` of them."""
    lo_hi = df.agg(F.percentile_approx(coarse_col, [0.01, 0.99], 100)).first()[0]
    return max(1, (lo_hi[1] - lo_hi[0]) // BLOCKS) if lo_hi else 1


def partition_keys(spark: SparkSession, n: int) -> list:
    """For each of ``n`` partitions an integer that hash partitioning deals to it."""
    ids = spark.range(64 * n).select(F.col("id").cast("int").alias("v"))      # misses a partition once in e^64
    return [r.v for r in ids.groupBy(F.pmod(F.hash("v"), F.lit(n)).alias("p")).agg(F.min("v").alias("v")).orderBy("p").collect()]


def dealer(df: DataFrame, coarse_col: str, ranges: int):
    """A function (rows, integer column) -> rows dealt out by that column, in ``ranges``
    partitions of whole blocks: stretches of the column of about as many rows of
    ``df`` each, in order. Rows of several tables meet in the same partition. It adds
    ``_blk``, the block, and ``_r``, which tells the partitions apart (hash partitioning
    by ``_r``, so that joins and windows by it and more need no shuffle); rows of
    no block of ``df`` are left out."""
    width = block_width(df, coarse_col)
    d = df.where(F.col(coarse_col).isNotNull()).select(F.floor(F.col(coarse_col) / width).alias("_blk"), F.lit(0).alias("_g"))
    total = max(1, d.count())
    keys = F.array(*(F.lit(v) for v in partition_keys(df.sparkSession, ranges)))
    stretch = F.least(F.floor(F.col("_base") * ranges / total), F.lit(ranges - 1)).cast("int")
    blocks = block_starts(d, "_g", 1024).select("_blk", F.element_at(keys, stretch + 1).alias("_r"))
    return lambda rows, col: (rows.withColumn("_blk", F.floor(F.col(col) / width)).join(F.broadcast(blocks), "_blk")
                              .repartition(ranges, "_r"))


def ranged_sequence(df: DataFrame, group_col: str, order_cols: list, coarse_col: str, ranges: int,
                    out: str = "seq", pack=lambda d: d) -> DataFrame:
    """:func:`dense_sequence` for a ``df`` that is cheap to read twice, with its
    rows laid out by position: in ``ranges`` partitions of whole blocks, each
    sorted by position, then group. Rows are shuffled once, by the start
    of their block, and a window numbers each block where it lands. Blocks are
    as wide as gives about ``BLOCKS`` of them, so their starts are a small table. ``pack``
    may swap other columns for smaller ones: its result is shuffled and returned."""
    width = block_width(df, coarse_col)
    d = df.withColumn("_blk", F.floor(F.col(coarse_col) / width))
    d = pack(d.join(F.broadcast(block_starts(d, group_col, 1024)), [group_col, "_blk"]).drop("_blk"))
    kept = [c for c in d.columns if c != "_base"]
    d = (d.repartitionByRange(ranges, "_base", group_col))
    w_row = Window.partitionBy("_base", group_col).orderBy(*order_cols)
    return (d.withColumn(out, (F.col("_base") + F.row_number().over(w_row) - 1).cast("bigint"))
            .sortWithinPartitions(out, group_col).select(*kept, out))
