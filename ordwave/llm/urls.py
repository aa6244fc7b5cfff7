"""URL filter: fixed host and path rules, then mined association rules.

Fixed rules win (the longest that fits). Other URLs are judged by rules that
FP-growth mines from labelled URLs: combinations of URL tokens that imply the
label ``bad`` with enough support and confidence. Tokens that always occur
together are mined as one, so a URL that repeats does not multiply its tokens'
subsets. Rules match by an inverted
index (token to rules): a rule fires when all its tokens are found. Pages are
reduced to their distinct token sets before the index is probed, so a host
with a third of all pages is probed once.

Defined results: a null url, or one without ``://``, has empty host and path,
no rule, no tokens and is allowed; repeated rows and ids each give a row;
labels with a null id are ignored, repeated labels of an id are bad if any
is; without labels nothing is mined; other columns are ignored; any length
of URL gives all the tokens listed in :func:`tokens`; tokens below the least
row count are pruned by FP-growth.

DataFrame operations only.
"""

from __future__ import annotations

import math
import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from . import scratch

BAD = "label=bad"
GROWTH = 10_000      # labelled pages from which the least row count of a rule grows, with the root of their number
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
_HEAD = r"^(?s:.*?)://([^/?#]*)([^?#]*)"


def host(url: str = "url") -> Column:
    raw = F.coalesce(F.regexp_extract(F.col(url), _HEAD, 1), F.lit(""))
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)


def path(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), _HEAD, 2), F.lit(""))


def fixed_rule(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest (verdict, ``host/path``) rule that fits
    columns ``host`` and ``path``; null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):      # later and longer wins
        at = rule.index("/")
        fits = ((F.col("host") == rule[:at]) | F.endswith("host", F.lit("." + rule[:at]))) & F.startswith("path", F.lit(rule[at:]))
        text, verdict = F.when(fits, F.lit(rule)).otherwise(text), F.when(fits, F.lit(what)).otherwise(verdict)
    return text, verdict


def tokens(url: str = "url") -> Column:
    """Sorted distinct tokens of a URL: scheme, host, each shorter suffix of
    its labels, first host label and each inner one, each path segment with
    its depth (the first one plain), file ending, whether it has a query or a
    fragment, each query key, and each key with its value."""
    u = F.col(url)
    labels = F.split("host", r"\.")
    inner = F.slice(labels, 2, F.greatest(F.size(labels) - 3, F.lit(0)))
    # suffixes of three labels and more, below the whole host
    longer = F.when(F.size(labels) > 3, F.transform(F.sequence(F.lit(2), F.greatest(F.size(labels) - 2, F.lit(2))),
                                                    lambda i: F.concat(F.lit("suffix="), F.array_join(F.slice(labels, i, F.size(labels)), "."))))
    segments = F.filter(F.split("path", "/"), lambda x: x != "")
    dirs = F.transform(segments, lambda x, i: F.concat(F.lit("dir"), F.when(i == 0, F.lit("")).otherwise((i + 1).cast("string")), F.lit("="), x))
    args = F.filter(F.split(F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1), "&"), lambda x: x != "")
    got = [
        F.concat(F.lit("scheme="), F.lower(F.regexp_extract(u, r"^(?s:(.*?))://", 1))),
        F.concat(F.lit("host="), F.col("host")),
        F.concat(F.lit("top="), F.substring_index("host", ".", -1)),
        F.concat(F.lit("domain="), F.substring_index("host", ".", -2)),
        F.concat(F.lit("sub="), F.substring_index("host", ".", 1)),
        F.when(F.rlike("path", F.lit(r"\.[A-Za-z0-9]{1,8}$")), F.concat(F.lit("ending="), F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})$", 1))),
        F.when(F.contains(u, F.lit("?")), F.lit("query")),
        F.when(F.contains(u, F.lit("#")), F.lit("fragment")),
    ]
    none = F.array().cast("array<string>")
    got = F.concat(F.array(*got), F.coalesce(F.transform(inner, lambda x: F.concat(F.lit("label="), x)), none), F.coalesce(longer, none), dirs,
                   F.transform(args, lambda x: F.concat(F.lit("key="), F.substring_index(x, "=", 1))),
                   F.transform(F.filter(args, lambda x: F.contains(x, F.lit("="))), lambda x: F.concat(F.lit("arg="), x)))
    return F.when(F.col("host") != "", F.array_sort(F.array_distinct(F.array_compact(got)))).otherwise(F.array().cast("array<string>"))


def mine(pages: DataFrame, labels: DataFrame, min_support: float, min_confidence: float, min_rows: int = 20, id_col: str = "page_id") -> DataFrame:
    """Rules ``(rule_id, items, members, confidence)`` whose consequent is
    ``bad``. Tokens found in the same labelled pages are one item, named by the
    least of them; ``members`` has the tokens of each item, any of which will
    do. An item that is confident enough alone is a rule, and in no other:
    the pages it is in are judged by it. FP-growth combines the rest. A rule is
    pruned when a rule with fewer items, all among its own, is as confident."""
    marked = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id"))
              .agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("__bad")))
    sets = scratch.table(pages.where(F.size("tokens") > 0).join(marked, F.col(id_col) == F.col("__id"))
                         .groupBy("tokens").agg(F.count("*").alias("n"), F.sum(F.coalesce("__bad", F.lit(0))).alias("b"))
                         .withColumn("id", F.monotonically_increasing_id()), "baskets")
    n = sets.agg(F.sum("n")).first()[0] or 0
    # a rule also needs min_rows labelled rows (growing with the root of their number), or few labels would give rules of one URL
    need = max(1, math.ceil(max(min_support * n, min_rows * max(1.0, n / GROWTH) ** 0.5) - 1e-9))
    tokens_of = sets.select("id", "n", "b", F.explode("tokens").alias("item"))
    classes = scratch.table(
        tokens_of.groupBy("item").agg(F.sum("n").alias("rows"), F.sum("b").alias("bad"), F.count("*").alias("k"),
                                      F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
        .where(F.col("bad") >= need).groupBy("rows", "bad", "k", "x", "y")
        .agg(F.min("item").alias("item"), F.sort_array(F.collect_list("item")).alias("members"))
        .select("item", "members", (F.col("bad") / F.col("rows")).alias("confidence")), "classes")
    single = classes.where(F.col("confidence") >= min_confidence).select(F.array("item").alias("items"), F.array("members").alias("members"), "confidence")
    rest = classes.where(F.col("confidence") < min_confidence)
    found = single
    if not rest.isEmpty():
        left = scratch.table(tokens_of.join(rest.select("item"), "item").groupBy("id", "n", "b").agg(F.collect_set("item").alias("items")), "left")
        bad = F.concat("items", F.array(F.lit(BAD)))
        rows = left.select(F.explode(F.concat(F.array_repeat(bad, F.col("b").cast("int")), F.array_repeat(F.col("items"), (F.col("n") - F.col("b")).cast("int")))).alias("items"))
        total = left.agg(F.sum("n")).first()[0]
        model = FPGrowth(itemsCol="items", minSupport=min(1.0, (need - 0.5) / total), minConfidence=min_confidence).fit(rows)
        mined = model.associationRules.where(F.element_at("consequent", 1) == BAD).select(F.array_sort("antecedent").alias("items"), "confidence")
        named = (mined.select("items", "confidence", F.posexplode("items").alias("at", "item")).join(rest.select("item", "members"), "item")
                 .groupBy("items", "confidence").agg(F.array_sort(F.collect_list(F.struct("at", "members"))).alias("m")))
        found = found.unionByName(named.select("items", F.col("m.members").alias("members"), "confidence"))
    found = scratch.table(found.select(F.xxhash64("items").alias("rule_id"), "items", "members", "confidence"), "rules")
    # inverted index over the rules of several items finds the more general ones
    several = found.where(F.size("items") > 1)
    small = several.select(F.col("rule_id").alias("g_id"), F.size("items").alias("g_n"), F.col("confidence").alias("g_conf"), F.explode("items").alias("item"))
    large = several.select("rule_id", F.size("items").alias("n"), "confidence", F.explode("items").alias("item"))
    general = (large.join(small, "item").where((F.col("g_n") < F.col("n")) & (F.col("g_conf") >= F.col("confidence")))
               .groupBy("rule_id", "g_id", "g_n").agg(F.count("*").alias("hits")).where(F.col("hits") == F.col("g_n")).select("rule_id").distinct())
    return scratch.table(found.join(general, "rule_id", "left_anti"), "pruned")


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Best rule of each distinct token set: ``tokens``, ``confidence``, ``mined``."""
    index = (rules.select("rule_id", F.size("items").alias("need"), "confidence", F.array_join("items", " ").alias("mined"), F.posexplode("members").alias("slot", "any"))
             .select("rule_id", "need", "confidence", "mined", "slot", F.explode("any").alias("item")))
    hits = (sets.select("tokens", F.explode("tokens").alias("item")).join(index, "item")
            .groupBy("tokens", "rule_id", "need", "confidence", "mined").agg(F.size(F.collect_set("slot")).alias("k")).where(F.col("k") == F.col("need")))
    return hits.groupBy("tokens").agg(F.max(F.struct("confidence", "mined")).alias("best")).select("tokens", "best.confidence", "best.mined")


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]] = RULES, min_support: float = 0.0,
          min_confidence: float = 0.6, min_rows: int = 20, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col``, host, path, rule, verdict, and the mined rule that decided."""
    base = (pages.select(F.col(id_col).alias(id_col), F.col(url_col).cast("string").alias("url"))
            .withColumn("host", host()).withColumn("path", path()).withColumn("tokens", tokens()))
    text, what = fixed_rule(rules)
    mined = mine(base.select(id_col, "tokens"), labels, min_support, min_confidence, min_rows, id_col)
    open_ = base.withColumn("rule", text).withColumn("fixed", what)
    sets = open_.where(F.col("rule").isNull() & (F.size("tokens") > 0)).select("tokens").distinct()
    best = scratch.table(match(sets, mined), "matched")
    key = F.when(F.col("rule").isNull(), F.col("tokens"))
    return (open_.withColumn("k", key).join(best.withColumnRenamed("tokens", "k"), "k", "left")
            .select(id_col, "host", "path", "rule",
                    F.coalesce("fixed", F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                    F.when(F.col("rule").isNull(), F.col("mined")).alias("mined")))
