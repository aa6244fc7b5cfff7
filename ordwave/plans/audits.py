"""Data-quality audits over landed tables (Q1-Q4).

Each audit is one pass over the landed rows after joins to dimensions:
the fixed, bounded dimensions are broadcast explicitly; the product
dimension (its size follows ``part``) is joined by key and left to the
size-checked planner. Group totals are aggregates joined back on their
key, never a window over an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.business import (
    CENT_TOLERANCE,
    order_id_format_ok,
    order_value,
    own_price_band,
    price_diff,
    price_diff_pct,
    price_tier,
)
from ..config import work_root
from ..operators import dims


def _abs_diff_ok(a, b):
    return F.abs(a - b) <= CENT_TOLERANCE


def order_rule_flags(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """Landed orders with one boolean column per contract rule (True =
    violation)."""
    profiles = dims.discount_profile_dim(spark, sf_dir)
    pairs = dims.region_city_pairs(spark, sf_dir).withColumn("_pair_ok", F.lit(True))
    pay = dims.payment_mix_dim(spark).select("price_tier", "payment_method", F.lit(True).alias("_pay_ok"))
    segs = dims.segment_mix_dim(spark).select("customer_segment", F.lit(True).alias("_seg_ok"))
    o = (dims.with_discount_profile(orders, profiles)
         .join(F.broadcast(pairs), ["region", "city"], "left")
         .join(F.broadcast(pay), ["price_tier", "payment_method"], "left")
         .join(F.broadcast(segs), ["customer_segment"], "left"))
    limited = F.col("category") == dims.LIMITED_QTY_CATEGORY
    q = F.col("quantity")
    qty_ok = q.isNotNull() & (q >= 1) & F.when(limited, q <= len(dims.QTY_WEIGHTS_LIMITED)).otherwise(
        q <= len(dims.QTY_WEIGHTS_DEFAULT))
    total_ok = _abs_diff_ok(order_value("final_price", "quantity"), F.col("total_value"))
    return o.select(
        (~order_id_format_ok("order_id")).alias("order_id_format"),
        (~F.coalesce(price_tier("base_price") == F.col("price_tier"), F.lit(False))).alias("price_tier"),
        (~F.coalesce(total_ok, F.lit(False))).alias("total_value"),
        (~F.coalesce(own_price_band("final_price", "base_price"), F.lit(False))).alias("own_price_band"),
        dims.discount_bucket("discount_percent", "buckets").isNull().alias("discount_profile"),
        (~qty_ok).alias("quantity_domain"),
        F.col("_pair_ok").isNull().alias("city_in_region"),
        F.col("_pay_ok").isNull().alias("payment_domain"),
        F.col("_seg_ok").isNull().alias("segment_domain"),
        (~F.coalesce(F.col("event_type") == "order_placed", F.lit(False))).alias("event_type"),
    )


def pricing_rule_flags(spark: SparkSession, sf_dir: str, pricing: DataFrame) -> DataFrame:
    products = dims.product_dim(spark, sf_dir).select("product_id", F.col("base_price").alias("_base"))
    comp = dims.competitor_dim(spark).withColumn("_comp_ok", F.lit(True))
    p = (pricing.join(products, "product_id", "left")
         .join(F.broadcast(comp), "competitor", "left")
         .withColumn("_tier", price_tier("_base")))
    lo, hi = dims.competitor_band("_base", "_tier")
    diff_ok = _abs_diff_ok(price_diff("our_price", "competitor_price"), F.col("price_diff"))
    pct_ok = (F.col("price_diff_pct").isNull() & price_diff_pct("price_diff", "our_price").isNull()) | \
        _abs_diff_ok(price_diff_pct("price_diff", "our_price"), F.col("price_diff_pct"))
    return p.select(
        (~F.coalesce(diff_ok, F.lit(False))).alias("price_diff"),
        (~F.coalesce(pct_ok, F.lit(False))).alias("price_diff_pct"),
        (~F.coalesce(F.col("competitor_price").between(lo, hi), F.lit(False))).alias("competitor_band"),
        F.col("_comp_ok").isNull().alias("unknown_competitor"),
        (~F.coalesce(F.col("event_type") == "price_update", F.lit(False))).alias("event_type"),
    )


def _violations(flags: DataFrame, table: str) -> DataFrame:
    rules = flags.columns
    counts = flags.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(r)).alias(r) for r in rules])
    stack = ", ".join(f"'{r}', `{r}`" for r in rules)
    return counts.select(F.lit(table).alias("table_name"), "n",
                         F.expr(f"stack({len(rules)}, {stack}) as (rule, violations)"))


def contract_audit(spark: SparkSession, sf_dir: str, orders: DataFrame, pricing: DataFrame) -> DataFrame:
    """Q1: one pass per table, one violation count per rule."""
    return (_violations(order_rule_flags(spark, sf_dir, orders), "orders")
            .unionByName(_violations(pricing_rule_flags(spark, sf_dir, pricing), "pricing_events")))


def mix_audit(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """Q2: observed share vs configured weight by region, product, segment,
    payment method within tier, and quantity (by category kind).

    One pass over the orders: the five groupings are grouping sets of one
    aggregate (one Expand, one shuffle), checkpointed. Counts and weights
    meet in one full outer join on (dimension, parent, key); per-(dimension,
    parent) totals are a handful of rows, broadcast back on those keys."""
    kind = F.when(F.col("category") == dims.LIMITED_QTY_CATEGORY, "limited").otherwise("default")
    base = orders.select("region", "product_id", "customer_segment", "price_tier", "payment_method",
                         kind.alias("qty_kind"), F.col("quantity").cast("string").alias("qty"))
    sets = [["region"], ["product_id"], ["customer_segment"], ["price_tier", "payment_method"], ["qty_kind", "qty"]]
    g = base.groupingSets(sets, *base.columns).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.grouping(c).alias(f"g_{c}") for c in ("region", "product_id", "customer_segment", "price_tier")])
    grouped = {c: F.col(f"g_{c}") == 0 for c in ("region", "product_id", "customer_segment", "price_tier")}
    dimension = (F.when(grouped["region"], "region").when(grouped["product_id"], "product")
                 .when(grouped["customer_segment"], "segment").when(grouped["price_tier"], "payment_method")
                 .otherwise("quantity"))
    parent = (F.when(grouped["price_tier"], F.col("price_tier"))
              .when(~(grouped["region"] | grouped["product_id"] | grouped["customer_segment"]), F.col("qty_kind"))
              .otherwise(F.lit("all")))
    key = (F.when(grouped["region"], F.col("region")).when(grouped["product_id"], F.col("product_id"))
           .when(grouped["customer_segment"], F.col("customer_segment"))
           .when(grouped["price_tier"], F.col("payment_method")).otherwise(F.col("qty")))
    # the aggregate (one row per key) feeds both the join and the totals:
    # materialised once so the orders are scanned once
    work_root(spark)
    observed = g.select(dimension.alias("dimension"), parent.alias("parent"), key.alias("key"), "n").checkpoint()

    all_ = F.lit("all")
    weights = (
        dims.region_weight_dim(spark, sf_dir).select(F.lit("region").alias("dimension"), all_.alias("parent"),
                                                     F.col("region").alias("key"), "weight")
        .unionByName(dims.product_dim(spark, sf_dir).select(
            F.lit("product").alias("dimension"), all_.alias("parent"), F.col("product_id").alias("key"), "weight"))
        .unionByName(dims.segment_mix_dim(spark).select(
            F.lit("segment").alias("dimension"), all_.alias("parent"), F.col("customer_segment").alias("key"),
            "weight"))
        .unionByName(dims.payment_mix_dim(spark).select(
            F.lit("payment_method").alias("dimension"), F.col("price_tier").alias("parent"),
            F.col("payment_method").alias("key"), "weight"))
        .unionByName(dims.quantity_mix_dim(spark).select(
            F.lit("quantity").alias("dimension"),
            F.when(F.col("is_limited"), "limited").otherwise("default").alias("parent"),
            F.col("quantity").cast("string").alias("key"), "weight")))
    keys = ["dimension", "parent"]
    n_tot = observed.groupBy(*keys).agg(F.sum("n").alias("_n_tot"))
    w_tot = weights.groupBy(*keys).agg(F.sum("weight").alias("_w_tot"))
    full = (observed.join(weights, keys + ["key"], "full_outer")
            .join(F.broadcast(n_tot), keys, "left").join(F.broadcast(w_tot), keys, "left"))
    return (full.select("dimension", "parent", "key",
                        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"),
                        F.coalesce(F.col("n") / F.col("_n_tot"), F.lit(0.0)).alias("share"),
                        (F.col("weight") / F.col("_w_tot")).alias("weight_share"))
            .withColumn("abs_diff", F.abs(F.col("share") - F.col("weight_share"))))


def return_rate_audit(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """Q3: observed return rate vs the brand's expected rate (J1 default)."""
    observed = orders.groupBy("brand").agg(F.count(F.lit(1)).alias("n"),
                                           F.count_if(F.col("is_returned")).alias("n_returned"))
    rated = dims.return_rate(observed, dims.brand_return_dim(spark, sf_dir))
    return (rated.select("brand", "n", "n_returned", (F.col("n_returned") / F.col("n")).alias("observed_rate"),
                         F.col("rate").alias("expected_rate"))
            .withColumn("abs_diff", F.abs(F.col("observed_rate") - F.col("expected_rate"))))


def competitor_audit(spark: SparkSession, pricing: DataFrame) -> DataFrame:
    """Q4: in-stock rate vs stock_rate; event share vs price_change_freq
    normalised over competitors. Rows whose competitor is unknown (J3) are
    reported under a NULL competitor. The share windows run over the few
    aggregated competitor rows only."""
    comp = dims.competitor_dim(spark)
    observed = pricing.groupBy("competitor").agg(F.count(F.lit(1)).alias("n"),
                                                 F.count_if(F.col("in_stock")).alias("n_in_stock"))
    everything = Window.partitionBy()
    j = observed.join(F.broadcast(comp), "competitor", "full_outer")
    known = F.col("price_change_freq").isNotNull()
    n_known = F.sum(F.when(known, F.col("n"))).over(everything)
    freq_tot = F.sum("price_change_pct").over(everything)
    return j.select(
        "competitor", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        F.coalesce("n_in_stock", F.lit(0)).cast("bigint").alias("n_in_stock"),
        (F.col("n_in_stock") / F.col("n")).alias("in_stock_rate"),
        F.col("stock_rate"),
        F.when(known, F.coalesce(F.col("n"), F.lit(0)) / n_known).alias("event_share"),
        (F.col("price_change_pct") / freq_tot).alias("expected_share"),
    )
