"""Preference formatting of chosen and rejected conversations.

The longest common turn prefix of a pair is rendered once, as its prompt; the
rest of each side follows as a masked completion. Everything stays one row
per turn: the first turn at which the sides differ is a grouped minimum, the
position of each turn in the rendered text is a running sum, and a completion
turn carries whether its text is trained on (assistant turns; their header is
not). So neither a pair nor a conversation is gathered into one value.

Turns are dealt out by ranges of (key, turn), which cut a long conversation
into chunks; numbers and offsets are counted within a chunk and raised by the
totals of the chunks before it. So no task has more than a chunk of it.

Defined results: turns are numbered by (turn, role, text), so repeated or
null turn numbers keep a fixed order (null first); null role or text counts
as empty; two turns are common if role and text are equal; a pair with a
missing side has an empty prompt; pairs with a null id are ignored; repeated
pairs count once; an empty table gives no rows; other columns are ignored.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import scratch

OPEN, CLOSE = "<|start|>", "<|end|>\n"


def _before(rows: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Per chunk of ``keys``, the total of ``value`` in the chunks before it."""
    total = rows.groupBy(*keys, "chunk").agg(F.sum(value).alias("total"))
    w = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # a table, a row per key and chunk: joined by its size, apart from the window's partitions
    return scratch.table(total.select(*keys, "chunk", F.coalesce(F.sum("total").over(w), F.lit(0).cast("long")).alias("before")), "before")


def numbered(turns: DataFrame, key: str) -> DataFrame:
    """``key``, ``pos`` (from 0), role, text and chunk of each turn, as a table."""
    t = turns.where(F.col(key).isNotNull()).select(
        F.col(key), F.col("turn").alias("__turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("__turn").asc_nulls_first(), F.col("role"), F.col("text")]
    t = scratch.table(t.repartitionByRange(F.col(key), *order).withColumn("chunk", F.spark_partition_id()), "turns")
    local = F.row_number().over(Window.partitionBy(key, "chunk").orderBy(*order)) - 1
    placed = t.withColumn("local", local).join(_before(t, [key], F.lit(1)), [key, "chunk"])
    return scratch.table(placed.select(key, (F.col("before") + F.col("local")).cast("int").alias("pos"), "role", "text", "chunk"), "numbered")


def format_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """Both inputs: ``key, turn, role, text``. Returns a row per rendered turn:
    ``key``, ``part`` (prompt, chosen, rejected), ``pos``, role, ``rendered``,
    ``start`` and ``end`` (characters within the part), ``mask_start`` and
    ``mask_end`` (the trained characters; null if none)."""
    return format_numbered(numbered(chosen, key), numbered(rejected, key), key)


def format_numbered(chosen: DataFrame, rejected: DataFrame, key: str, trailing: DataFrame | None = None) -> DataFrame:
    """As :func:`format_pairs`, of sides that are numbered; ``trailing`` turns
    belong to neither side and make a part of their own."""
    sides = chosen.withColumn("side", F.lit("chosen")).unionByName(rejected.withColumn("side", F.lit("rejected")))
    # the sides of a position differ if it has one side only, or two contents
    content = F.struct("role", "text")
    differ = (sides.groupBy(key, "pos").agg(F.count("*").alias("n"), F.min(content).alias("lo"), F.max(content).alias("hi"))
              .groupBy(key).agg(F.min(F.when((F.col("n") < 2) | (F.col("lo") != F.col("hi")), F.col("pos"))).alias("first")))
    rows = sides.join(scratch.table(differ, "differ"), key).withColumn("common", F.coalesce(F.col("pos") < F.col("first"), F.lit(True)))
    rows = (rows.where(~F.col("common") | (F.col("side") == "chosen"))
            .select(key, "pos", "role", "text", "chunk", F.when(F.col("common"), F.lit("prompt")).otherwise(F.col("side")).alias("part")))
    if trailing is not None:
        rows = rows.unionByName(trailing.withColumn("part", F.lit("trailing")))
    head = F.concat(F.lit(OPEN), F.col("role"), F.lit("\n"))
    rows = rows.withColumn("rendered", F.concat(head, F.col("text"), F.lit(CLOSE)))
    size = F.length("rendered").cast("long")
    local = F.sum(size).over(Window.partitionBy(key, "part", "chunk").orderBy("pos"))
    rows = rows.withColumn("local", local).join(_before(rows, [key, "part"], size), [key, "part", "chunk"])
    trained = F.col("part").isin("chosen", "rejected") & (F.col("role") == "assistant")
    return (rows.withColumn("end", F.col("before") + F.col("local")).withColumn("start", F.col("end") - size)
            .withColumn("mask_start", F.when(trained, F.col("start") + F.length(head)))
            .withColumn("mask_end", F.when(trained, F.col("end") - 1))
            .select(key, "part", "pos", "role", "rendered", "start", "end", "mask_start", "mask_end"))


def format_conversations(conv: DataFrame, key: str = "conv_id") -> DataFrame:
    """Pairs made from conversations, all their turns rendered. The chosen side is
    the conversation up to its last assistant turn; the rejected side ends in the
    assistant turn before that one, given again in its place, or, without
    one, before the last assistant turn (its completion is missing). Turns after the last
    assistant turn are the part ``trailing``; a conversation without assistant
    turns is all prompt."""
    t = numbered(conv, key)
    answer = F.when(F.col("role") == "assistant", F.col("pos"))
    last = t.groupBy(key).agg(F.max(answer).alias("last"))
    marked = scratch.table(t.join(scratch.table(last, "last"), key), "marked")
    prior = (marked.where((F.col("role") == "assistant") & (F.col("pos") < F.col("last")))
             .groupBy(key).agg(F.max_by("text", "pos").alias("prior")))
    marked = marked.join(scratch.table(prior, "prior"), key, "left")
    at = F.coalesce(F.col("pos") - F.col("last"), F.lit(-1))                  # from the last answer
    columns = (key, "pos", "role", "chunk")
    chosen = marked.where(at <= 0).select(*columns, "text")
    rejected = (marked.where((at < 0) | ((at == 0) & F.col("prior").isNotNull()))
                .select(*columns, F.when(at == 0, F.col("prior")).otherwise(F.col("text")).alias("text")))
    return format_numbered(chosen, rejected, key, marked.where(at > 0).select(*columns, "text"))
