"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by their number of distinct word shingles. Within
a size class every item is represented by its smallest shingle hashes; the
class fixes how many: one more than the shingles an item of the class may
lack at the containment threshold. A document that contains enough of an item
therefore has at least one of its minima (no miss is possible), and looking
up the minima in the documents' shingles gives the candidates. Candidates are
verified by exact shingle containment.

The lookup joins document shingles with the item sketch, a table of known
size: Spark broadcasts it while it is small and shuffles by shingle hash
otherwise.

Defined results: a text with fewer than ``size`` words has its whole word
sequence as its one shingle, a text without words (or null) has none and
matches nothing; a pair is listed once however often rows repeat; null ids
are kept as null; empty tables give no pairs; other columns are ignored.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import scratch

WHITE = " \t\n\x0b\x0c\r"


def words(text: str) -> Column:
    """Lower-cased words between white space; an empty array without words."""
    t = F.btrim(F.lower(F.col(text)), F.lit(WHITE))
    return F.when(F.length(t) > 0, F.split(t, r"[ \t-\r]+")).otherwise(F.array().cast("array<string>"))


def shingles(df: DataFrame, keep: list[str], text: str, size: int = 5) -> DataFrame:
    """One row per word shingle position: ``keep`` and ``sh`` (64-bit hash)."""
    w = df.select(*keep, words(text).alias("w")).where(F.size("w") > 0)
    at = w.select(*keep, "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))).alias("i"))
    # get() is null past the end, and xxhash64 skips nulls: short texts hash their whole sequence
    return at.select(*keep, F.xxhash64(*(F.get("w", F.col("i") + j) for j in range(size))).alias("sh"))


def sketch(items: DataFrame, threshold: float, id_col: str = "item_id", text_col: str = "text", size: int = 5) -> DataFrame:
    """``item``, ``id_col``, ``n_item``, ``sh``, ``is_min`` for each distinct shingle."""
    it = (items.select(F.col(id_col), F.col(text_col).cast("string").alias("__t"))
          .withColumn("item", F.xxhash64(F.col(id_col), F.coalesce("__t", F.lit("")))))
    sh = shingles(it, ["item", id_col], "__t", size).distinct()
    per = Window.partitionBy("item")
    n = sh.withColumn("n_item", F.count("*").over(per))
    # size class: powers of two; its largest item may lack (1 - threshold) of its shingles
    top = F.pow(2.0, F.floor(F.log2("n_item")) + 1) - 1
    minima = F.floor(top * (1 - threshold) + 1e-9) + 1
    rank = F.row_number().over(per.orderBy(F.xxhash64("sh", F.lit(17)), "sh"))
    return n.withColumn("is_min", rank <= minima)


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.75, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", size: int = 5) -> DataFrame:
    """Pairs ``id_col, item_col, n_item, n_shared`` with ``n_shared >= threshold * n_item``,
    and ``dk``, the hash that names the document's text."""
    sk = scratch.table(sketch(items, threshold, item_col, item_text, size), "sketch")
    src = _keyed(docs, id_col, text_col)
    minima = sk.where("is_min").select("sh", "item").distinct()
    cand = scratch.table(shingles(src, ["dk"], "__t", size).join(minima, "sh").select("dk", "item").distinct(), "candidates")
    again = src.join(cand.select("dk").distinct(), "dk", "left_semi")
    shared = (shingles(again, ["dk", id_col], "__t", size).join(sk.select("sh", "item", F.col(item_col).alias(item_col), "n_item"), "sh")
              .select("dk", id_col, "item", item_col, "n_item", "sh").distinct()
              .groupBy("dk", id_col, "item", item_col, "n_item").agg(F.count("*").alias("n_shared"))
              .where(F.col("n_shared") >= threshold * F.col("n_item")))
    # a pair counts only if the sketch proposed it
    return shared.join(cand, ["dk", "item"], "left_semi").select(id_col, item_col, "n_item", "n_shared", "dk").distinct()


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, text and ``dk``, the hash of both."""
    return (docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__t")).where(F.col("__t").isNotNull())
            .withColumn("dk", F.xxhash64(F.col(id_col), F.col("__t"))))


def clean(docs: DataFrame, items: DataFrame, threshold: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without a contained item; all columns of ``docs``."""
    hits = scratch.table(contaminated(docs, items, threshold, id_col, text_col).select(F.col("dk").alias("__dk")).distinct(), "contaminated")
    key = F.xxhash64(F.col(id_col), F.col(text_col).cast("string"))
    return docs.join(hits, F.coalesce(key, F.lit(0)) == F.col("__dk"), "left_anti")
