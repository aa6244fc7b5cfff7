"""Robust multivariate outliers: minimum covariance determinant per group.

Each text becomes a vector of transformed statistics. For each (lang, source)
the estimate starts at the coordinate medians and their absolute deviations
and takes concentration steps: Mahalanobis distances of all rows of the
group, the half with the smallest distances (found on a histogram of
distances), mean and covariance of that half. The covariance is made
consistent with the chi-squared median, and rows whose distance passes the
cut are rejected. Moments, medians and histograms are grouped aggregates with
partial sums in each task, so a group of any size is never gathered.

Defined results: a null text has no words and fails the base rule; a null
lang or source is a group of its own; groups with fewer than ``min_rows``
rows that pass the base rule take the estimate of all rows; repeated rows and
ids each give a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import scratch
from .textnum import EXACT, WHITE, blocks, doc_slices, span_keys, windows

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True
FEATURES = ["f_len", "f_word", "f_symbols", "f_lines", "f_repeat"]
FLOOR = 0.15         # least spread of a coordinate: constant statistics must not reject
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
BIN = 64             # histogram bins per unit of log distance


def _repeats(keys: np.ndarray, owner: np.ndarray, n: int, size: int = 8) -> np.ndarray:
    """Words of each text inside a ``size``-word window that occurs twice or more in it."""
    w = windows(keys, size)
    if not len(w):
        return np.zeros(n, np.int64)
    idx = np.flatnonzero(owner[: len(w)] == owner[size - 1 :])
    vals, docs = w[idx], owner[idx]
    order = np.lexsort((vals, docs))
    same = (vals[order][1:] == vals[order][:-1]) & (docs[order][1:] == docs[order][:-1])
    twice = np.zeros(len(idx), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(keys) + 1, np.int64)
    np.add.at(cover, idx[twice], 1)
    np.add.at(cover, idx[twice] + size, -1)
    return np.bincount(owner[np.cumsum(cover[:-1]) > 0], minlength=n)


def _dup_lines(block, prefix: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    n = len(block.bounds) - 1
    starts, ends, owner = block.runs(NEWLINE)
    has = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends, owner = starts[has], ends[has], owner[has]
    keys = span_keys(prefix, starts, ends)
    order = np.lexsort((keys, ends - starts, owner))
    k, ln, d = keys[order], (ends - starts)[order], owner[order]
    same = (k[1:] == k[:-1]) & (ln[1:] == ln[:-1]) & (d[1:] == d[:-1])
    return np.bincount(d[1:][same], minlength=n)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, lang, source and the five counts of each whole text."""
    def run(batches):
        for batch in batches:
            col = batch.column(3)
            out = {s: np.zeros(len(col), np.int64) for s in STATS}
            for b in blocks(col):
                n = len(b.bounds) - 1
                at = slice(b.first, b.first + n)
                starts, ends, owner = b.runs(WHITE)
                prefix = b.prefix(EXACT)
                out["n_words"][at] = np.diff(doc_slices(owner, n))
                chars = np.concatenate(([0], np.cumsum(~WHITE[b.data] & ((b.data & 0xC0) != 0x80))))
                out["word_chars"][at] = chars[b.bounds[1:]] - chars[b.bounds[:-1]]
                syms = np.concatenate(([0], np.cumsum(SYMBOL[b.data])))
                out["n_symbols"][at] = syms[b.bounds[1:]] - syms[b.bounds[:-1]]
                out["n_dup_lines"][at] = _dup_lines(b, prefix, starts)
                out["n_repeat_words"][at] = _repeats(span_keys(prefix, starts, ends), owner, n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), *(pa.array(out[s]) for s in STATS)],
                [id_col, "lang", "source", *STATS])

    src = docs.select(F.col(id_col).alias(id_col), F.col("lang").cast("string").alias("lang"),
                      F.col("source").cast("string").alias("source"), F.col(text_col).cast("string").alias("__text"))
    kind = src.schema[id_col].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, lang string, source string, " + ", ".join(f"{s} long" for s in STATS))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _vectors(df: DataFrame) -> DataFrame:
    w = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return df.select(
        "*", base_failed().alias("base_failed"),
        (F.log(w) / 2).alias("f_len"),
        (F.log((F.col("word_chars") + 1) / w) * 4).alias("f_word"),
        F.log1p(40 * F.col("n_symbols") / w).alias("f_symbols"),
        (F.log1p(F.col("n_dup_lines").cast("double")) / 3).alias("f_lines"),
        F.sqrt(F.col("n_repeat_words") / w).alias("f_repeat"))


KEYS = ["lang", "source"]


def _grouped(rows: DataFrame, levels: bool):
    """The estimate's groups: each (lang, source), and all rows under ``all``."""
    return rows.withColumn("grp", F.explode(F.array(_key(), F.lit("all")))) if levels else rows.withColumn("grp", _key())


def _key() -> Column:
    """One string per (lang, source); lengths keep ("a", "bc") and ("ab", "c") apart."""
    return F.concat(*(F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("~")) for c in KEYS))


def _solve(params):
    """Per group: inverse covariance (with the spread floor) of the moments."""
    def run(batches):
        d = len(FEATURES)
        for batch in batches:
            x = batch.to_pydict()
            out = {"grp": [], "n": [], "center": [], "inv": []}
            for k in range(batch.num_rows):
                n = max(1.0, x["n"][k])
                mean = np.array(x["s"][k]) / n
                cov = np.zeros((d, d))
                cov[np.triu_indices(d)] = np.array(x["ss"][k]) / n
                cov = np.triu(cov) + np.triu(cov, 1).T - np.outer(mean, mean)
                cov = cov * params["scale"] + np.eye(d) * FLOOR**2
                out["grp"].append(x["grp"][k])
                out["n"].append(int(n))
                out["center"].append(mean.tolist())
                out["inv"].append(np.linalg.inv(cov).ravel().tolist())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("grp", pa.string()), ("n", pa.int64()), ("center", pa.list_(pa.float64())), ("inv", pa.list_(pa.float64()))]))
    return run


def _distance() -> Column:
    d = len(FEATURES)
    diff = [F.col(f) - F.col("center")[i] for i, f in enumerate(FEATURES)]
    total = F.lit(0.0)
    for i in range(d):
        for j in range(i, d):
            total = total + (1 if i == j else 2) * diff[i] * diff[j] * F.col("inv")[i * d + j]
    return total


def _moments(rows: DataFrame) -> DataFrame:
    d = len(FEATURES)
    return rows.groupBy("grp").agg(
        F.count("*").cast("double").alias("n"),
        F.array(*(F.sum(f) for f in FEATURES)).alias("s"),
        F.array(*(F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])) for i in range(d) for j in range(i, d))).alias("ss"))


SMALL = 10_000       # groups; an estimate has about 300 bytes


def _beside(est: DataFrame, groups: int) -> DataFrame:
    """One row per group, broadcast while the groups are few, so that rows of
    a large group stay where they are; otherwise left to the planner, which
    splits skewed groups."""
    return F.broadcast(est) if groups <= SMALL else est


EST = "grp string, n long, center array<double>, inv array<double>"


def estimate(vectors: DataFrame, steps: int = 3) -> DataFrame:
    """Robust centre and inverse covariance of each group, and of all rows."""
    rows = _grouped(vectors.where(~F.col("base_failed")), True).select("grp", *FEATURES)
    # coordinate medians and absolute deviations
    med = rows.groupBy("grp").agg(F.array(*(F.percentile_approx(f, 0.5, 1000) for f in FEATURES)).alias("med"))
    med = scratch.table(med, "medians")
    groups = med.count()
    dev = rows.join(_beside(med, groups), "grp").groupBy("grp").agg(
        F.count("*").cast("long").alias("n"), F.first("med").alias("center"),
        F.array(*(F.percentile_approx(F.abs(F.col(f) - F.col("med")[i]), 0.5, 1000) for i, f in enumerate(FEATURES))).alias("mad"))
    d = len(FEATURES)
    est = scratch.table(dev.select("grp", "n", "center", F.array(*(
        (1 / (F.pow(F.col("mad")[i] * 1.4826, 2) + FLOOR**2)) if i == j else F.lit(0.0)
        for i in range(d) for j in range(d))).alias("inv")), "mcd0")
    # 2.198 = 5 / (mean of the inner half of a chi-squared with 5 degrees of freedom): consistency at the normal
    for step in range(steps):
        dist = rows.join(_beside(est, groups), "grp").withColumn("bin", F.floor(F.log1p(_distance()) * BIN).cast("int"))
        hist = dist.groupBy("grp", "bin").agg(F.count("*").alias("k"))
        run = Window.partitionBy("grp").orderBy("bin")
        cut = (hist.withColumn("below", F.sum("k").over(run))
               .withColumn("total", F.sum("k").over(Window.partitionBy("grp")))
               .where(2 * F.col("below") >= F.col("total")).groupBy("grp").agg(F.min("bin").alias("cut")))
        half = dist.join(_beside(cut, groups), "grp").where(F.col("bin") <= F.col("cut"))
        est = scratch.table(_moments(half).mapInArrow(_solve({"scale": 2.198}), EST), f"mcd{step + 1}")
    return est


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_rows: int = 50,
          cut: float = 45.0, steps: int = 3) -> DataFrame:
    """Counts, base rule and verdict for each text. ``distance`` is the
    squared Mahalanobis distance to the text's group (null if ``base_failed``)."""
    vec = _vectors(scratch.table(statistics(docs, id_col, text_col), "stats"))
    est = estimate(vec, steps)
    every = est.where("grp = 'all'").select(F.col("center").alias("c_all"), F.col("inv").alias("i_all"), F.lit(1).alias("one"))
    own = _beside(est.where(F.col("n") * 2 >= min_rows).withColumnRenamed("grp", "g"), est.count())
    rows = (vec.withColumn("grp", _key()).withColumn("one", F.lit(1))
            .join(own, F.col("grp") == F.col("g"), "left").join(F.broadcast(every), "one", "left")  # one row
            .withColumn("center", F.coalesce("center", "c_all")).withColumn("inv", F.coalesce("inv", "i_all")))
    dist = F.when(~F.col("base_failed"), _distance())
    return rows.select(id_col, "lang", "source", *STATS, "base_failed", dist.alias("distance"),
                       (~F.col("base_failed") & F.coalesce(dist <= cut, F.lit(True))).alias("kept"))
