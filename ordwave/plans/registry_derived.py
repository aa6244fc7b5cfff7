"""Registered queries for derived columns, lookups, audits and the JSON
round trip (D*, J*, Q*, P2/P9/P10/P13, K4)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import oracle as O
from ..config import IngestConfig
from ..functions.business import (
    CENT_TOLERANCE,
    is_weekend_spike,
    order_id_format_ok,
    order_value,
    own_price_band,
    price_diff,
    price_diff_pct,
    price_tier,
)
from ..functions.parse import coerce_booleans, to_iso_text, to_json_value
from ..functions.rounding import cents
from ..operators import dims, weighted
from ..operators.transform import landed_orders, orders_flagged
from ..schemas import ORDER_FIELDS, ORDERS, ORDERS_TOPIC
from ..sources.fixtures import publish_topics
from ..sources.kafka import record_files_stream
from ..sources.tables import read_table
from ..streaming.enrich import EnrichedLander, VersionedDim, read_enriched
from ..streaming.sinks import kafka_records_for
from ..streaming.streams import drain, start_ingest
from . import audits, landing
from .registry import ORACLE, records, register

TOL = O.TOL


def _orders(spark, sf_dir):
    return landing.landed(spark, sf_dir, "orders")


def _pricing(spark, sf_dir):
    return landing.landed(spark, sf_dir, "pricing_events")


# ---- derived columns ----------------------------------------------------------

@register("price_tier_counts", O.with_dims(
    f"SELECT {O.tier_sql('base_price')} AS tier, count(*) AS n, "
    f"count(*) FILTER (WHERE ({O.tier_sql('base_price')}) IS DISTINCT FROM price_tier) AS n_mismatch "
    "FROM good GROUP BY 1"))
def price_tier_counts(spark, sf_dir):
    """Tiers recomputed from the base price, vs the tier carried."""
    o = _orders(spark, sf_dir).withColumn("tier", price_tier("base_price"))
    return o.groupBy("tier").agg(F.count(F.lit(1)).alias("n"),
                                 F.count_if(~F.col("tier").eqNullSafe(F.col("price_tier"))).alias("n_mismatch"))


@register("order_value", O.with_dims(
    f"SELECT count(*) AS n, count(*) FILTER (WHERE quantity IS NULL OR final_price IS NULL) AS n_unknown, "
    f"count(*) FILTER (WHERE abs({O.r2('final_price * quantity')} - total_value) > {TOL}) AS n_mismatch, "
    "CAST(sum(CAST(floor(total_value * 100 + 0.5) AS BIGINT)) AS BIGINT) AS total_cents FROM good"))
def order_value_check(spark, sf_dir):
    """total = final price x quantity (the discount is not applied)."""
    o = _orders(spark, sf_dir)
    re = order_value("final_price", "quantity")
    return o.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col("quantity").isNull() | F.col("final_price").isNull()).alias("n_unknown"),
                 F.count_if(F.abs(re - F.col("total_value")) > CENT_TOLERANCE).alias("n_mismatch"),
                 F.sum(cents("total_value")).alias("total_cents"))


@register("price_diff_pct", O.with_dims(
    "SELECT count(*) AS n, "
    f"count(*) FILTER (WHERE abs({O.r2('our_price - competitor_price')} - price_diff) > {TOL}) AS n_diff_mismatch, "
    "count(*) FILTER (WHERE price_diff IS NULL) AS n_diff_missing, "
    f"count(*) FILTER (WHERE abs((CASE WHEN our_price = 0 THEN NULL ELSE {O.r2('price_diff / our_price * 100')} END)"
    f" - price_diff_pct) > {TOL}) AS n_pct_mismatch, "
    "count(*) FILTER (WHERE price_diff_pct IS NULL) AS n_pct_null FROM pricing_parsed", pricing=True))
def price_diff_pct_check(spark, sf_dir):
    """D3 + D4: difference and percent recomputed from the prices."""
    p = _pricing(spark, sf_dir)
    d = price_diff("our_price", "competitor_price")
    pct = price_diff_pct("price_diff", "our_price")
    return p.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.abs(d - F.col("price_diff")) > CENT_TOLERANCE).alias("n_diff_mismatch"),
                 F.count_if(F.col("price_diff").isNull()).alias("n_diff_missing"),
                 F.count_if(F.abs(pct - F.col("price_diff_pct")) > CENT_TOLERANCE).alias("n_pct_mismatch"),
                 F.count_if(F.col("price_diff_pct").isNull()).alias("n_pct_null"))


@register("own_price_band", O.with_dims(
    "SELECT price_tier, count(*) AS n, count(*) FILTER (WHERE NOT coalesce(final_price BETWEEN "
    f"base_price * CAST(0.9 AS DOUBLE) - {TOL} AND base_price * CAST(1.06 AS DOUBLE) + {TOL}, false)) AS n_outside "
    "FROM good GROUP BY 1"))
def own_price_band_check(spark, sf_dir):
    """Own final price inside base x [0.90, 1.06]."""
    o = _orders(spark, sf_dir)
    inside = F.coalesce(own_price_band("final_price", "base_price"), F.lit(False))
    return o.groupBy("price_tier").agg(F.count(F.lit(1)).alias("n"), F.count_if(~inside).alias("n_outside"))


_BAND_SQL = f"""
, pb AS (
  SELECT p.competitor, p.competitor_price, pr.base_price AS base, {O.tier_sql('pr.base_price')} AS tier,
         c.budget_aggression AS b, c.premium_aggression AS pa
  FROM pricing_parsed p JOIN comp c ON p.competitor = c.competitor
  LEFT JOIN product pr ON p.product_id = pr.product_id),
pb2 AS (
  SELECT *, base * (CASE WHEN tier = 'budget' THEN b WHEN tier = 'premium' THEN pa ELSE (b + pa) / 2 END) - {TOL} AS lo,
         base * (CASE WHEN tier = 'budget' THEN CAST(1.05 AS DOUBLE) WHEN tier = 'premium' THEN CAST(1.02 AS DOUBLE)
                 ELSE CAST(1.04 AS DOUBLE) END) + {TOL} AS hi
  FROM pb)
SELECT competitor, tier AS price_tier, count(*) AS n, count(*) FILTER (WHERE competitor_price < lo) AS n_below,
       count(*) FILTER (WHERE competitor_price > hi) AS n_above
FROM pb2 GROUP BY 1, 2"""


@register("competitor_band", O.with_dims(_BAND_SQL, pricing=True))
def competitor_band_check(spark, sf_dir):
    """D7 + J3 + J4: competitor price vs the band of its (competitor, tier);
    strict lookup of the competitor profile (inner join), base price from the
    product dimension."""
    p = _pricing(spark, sf_dir)
    products = dims.product_dim(spark, sf_dir).select("product_id", F.col("base_price").alias("_base"))
    j = (p.join(F.broadcast(dims.competitor_dim(spark)), "competitor")
         .join(products, "product_id", "left")
         .withColumn("price_tier_", price_tier("_base")))
    lo, hi = dims.competitor_band("_base", "price_tier_")
    return (j.groupBy("competitor", F.col("price_tier_").alias("price_tier"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("competitor_price") < lo).alias("n_below"),
                 F.count_if(F.col("competitor_price") > hi).alias("n_above")))


@register("unmatched_competitors", O.with_dims(
    "SELECT p.competitor, count(*) AS n FROM pricing_parsed p WHERE p.competitor IS NULL "
    "OR NOT EXISTS (SELECT 1 FROM comp c WHERE c.competitor = p.competitor) GROUP BY 1", pricing=True))
def unmatched_competitors(spark, sf_dir):
    """Pricing events whose competitor has no profile (the rows that the
    strict lookup leaves out), by competitor; NULL for unparseable events."""
    p = _pricing(spark, sf_dir).join(F.broadcast(dims.competitor_dim(spark)), "competitor", "left_anti")
    return p.groupBy("competitor").agg(F.count(F.lit(1)).alias("n"))


@register("discount_bucket", O.with_dims(
    f"SELECT category, {O.discount_bucket_sql()} AS bucket, count(*) AS n FROM good GROUP BY 1, 2"))
def discount_bucket_check(spark, sf_dir):
    """D8 + J2: bucket of the discount in the category's profile (default
    profile when the category has none; NULL bucket = out of profile)."""
    o = dims.with_discount_profile(_orders(spark, sf_dir), dims.discount_profile_dim(spark, sf_dir))
    return (o.groupBy("category", dims.discount_bucket().alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


_SPIKE = ", ".join(f"'{c}'" for c in dims.SPIKE_CATEGORIES)


@register("weekend_spike", O.with_dims(
    "SELECT category, count(*) AS n, count(*) FILTER (WHERE isodow(\"timestamp\") >= 6) AS n_weekend, "
    f"count(*) FILTER (WHERE isodow(\"timestamp\") >= 6 AND category IN ({_SPIKE})) AS n_spike "
    "FROM good GROUP BY 1"))
def weekend_spike(spark, sf_dir):
    """D9 + F7: Saturday/Sunday orders in the spike categories."""
    o = _orders(spark, sf_dir)
    return o.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.weekday("timestamp") >= 5).alias("n_weekend"),
        F.count_if(is_weekend_spike("timestamp", "category", dims.SPIKE_CATEGORIES)).alias("n_spike"))


@register("order_id_format", O.with_dims(
    "SELECT count(*) AS n, count(*) FILTER (WHERE coalesce(regexp_matches(order_id, "
    "'^ORD-[A-Z]{2}[0-9]{4}[A-Z]{2}[0-9]{4}$'), false)) AS n_ok FROM good"))
def order_id_format(spark, sf_dir):
    """D10"""
    o = _orders(spark, sf_dir)
    return o.agg(F.count(F.lit(1)).alias("n"), F.count_if(order_id_format_ok("order_id")).alias("n_ok"))


def _weighted_sql(salt: str, source: str, option: str, order: str) -> str:
    return f"""
, wb AS (SELECT {option} AS option, sum(weight) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi,
                weight, sum(weight) OVER () AS total FROM {source}),
wbs AS (SELECT option, CAST(floor(CAST(hi - weight AS HUGEINT) * 4294967296 // total) AS BIGINT) AS lo_u,
               CAST(floor(CAST(hi AS HUGEINT) * 4294967296 // total) AS BIGINT) AS hi_u FROM wb),
hashed AS (SELECT CAST(('0x' || substr(md5('{salt}' || order_id), 1, 8)) AS BIGINT) AS u FROM good)
SELECT s.option AS {option}, count(*) AS n
FROM hashed h LEFT JOIN wbs s ON h.u >= s.lo_u AND h.u < s.hi_u GROUP BY 1"""


@register("weighted_bucket", O.with_dims(_weighted_sql("region|", "region_w", "region", "region")
                                         .replace("AS region, count", "AS assigned_region, count")))
def weighted_bucket(spark, sf_dir):
    """Each order id is given a region by deterministic weighted
    bucketing (md5 hash, exact cumulative thresholds)."""
    options = weighted.ranges(dims.region_weight_dim(spark, sf_dir), "region")
    o = weighted.assign(_orders(spark, sf_dir), "order_id", "region|", options, "assigned_region")
    return o.groupBy("assigned_region").agg(F.count(F.lit(1)).alias("n"))


@register("weighted_product", O.with_dims(_weighted_sql("product|", "product", "product_id", "p_partkey")
                                          .replace("AS product_id, count", "AS assigned_product, count")))
def weighted_product(spark, sf_dir):
    """D11 over a large dimension: each order id is given a product by the
    products' weights; running sums by blocks of part keys."""
    options = weighted.ranges(dims.product_dim(spark, sf_dir), "product_id", order="p_partkey", block="p_partkey")
    o = weighted.assign(_orders(spark, sf_dir), "order_id", "product|", options, "assigned_product")
    return o.groupBy("assigned_product").agg(F.count(F.lit(1)).alias("n"))


# ---- lookups --------------------------------------------------------------------

@register("return_rate_lookup", O.with_dims(
    "SELECT g.brand, coalesce(b.rate, CAST(0.08 AS DOUBLE)) AS rate, count(*) AS n "
    "FROM good g LEFT JOIN brand_ret b ON g.brand = b.brand GROUP BY 1, 2"))
def return_rate_lookup(spark, sf_dir):
    """Lookup with a scalar default, per order."""
    # count each brand's orders first: the lookup then sees one row per brand
    per_brand = _orders(spark, sf_dir).groupBy("brand").agg(F.count(F.lit(1)).alias("n"))
    return dims.return_rate(per_brand, dims.brand_return_dim(spark, sf_dir)).select("brand", "rate", "n")


@register("product_enrich", O.with_dims(
    "SELECT g.category, count(*) AS n, count(p.product_id) AS n_matched, "
    "count(*) FILTER (WHERE p.base_price = g.base_price) AS n_base_equal "
    "FROM good g LEFT JOIN product p ON g.product_id = p.product_id GROUP BY 1"))
def product_enrich(spark, sf_dir):
    """Product attributes attached to each order by key."""
    o = dims.with_product(_orders(spark, sf_dir), dims.product_dim(spark, sf_dir), cols=("base_price",))
    return o.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.count("dim_base_price").alias("n_matched"),
        F.count_if(F.col("dim_base_price") == F.col("base_price")).alias("n_base_equal"))


@register("orders_enriched_landed", ORACLE["product_enrich"])
def orders_enriched_landed(spark, sf_dir):
    """J4 on the stream: the landed orders carry the product attributes of the
    dimension's version at their micro-batch."""
    base = landing.new_run_dir(spark, "enriched")
    dim = VersionedDim(f"{base}/dims/product")
    dim.publish(dims.product_dim(spark, sf_dir))
    lander = EnrichedLander("orders", f"{base}/landed", orders_flagged, landed_orders, "orders", dim=dim)
    src = record_files_stream(spark, f"{publish_topics(spark, sf_dir, topics=(ORDERS_TOPIC,))}/{ORDERS_TOPIC}", landing.files_per_trigger(spark))
    drain([start_ingest(src, lander, f"{base}/checkpoint", IngestConfig(), available_now=True)])
    return read_enriched(spark, f"{base}/landed", "orders").groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.count("dim_base_price").alias("n_matched"),
        F.count_if(F.col("dim_base_price") == F.col("base_price")).alias("n_base_equal"))


@register("region_city_check", O.with_dims(
    "SELECT g.region, count(*) AS n, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM geo WHERE geo.region = g.region "
    "AND geo.city = g.city)) AS n_in_hierarchy FROM good g GROUP BY 1"))
def region_city_check(spark, sf_dir):
    """(region, city) membership in the region -> cities hierarchy, in
    one pass (a broadcast flag join)."""
    o = _orders(spark, sf_dir)
    pairs = dims.region_city_pairs(spark, sf_dir).withColumn("_in", F.lit(True))
    return (o.join(F.broadcast(pairs), ["region", "city"], "left")
            .groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.count("_in").alias("n_in_hierarchy")))


# ---- audits -----------------------------------------------------------------------

_O_RULES = {
    "order_id_format": "NOT coalesce(regexp_matches(order_id, '^ORD-[A-Z]{2}[0-9]{4}[A-Z]{2}[0-9]{4}$'), false)",
    "price_tier": f"NOT coalesce(({O.tier_sql('base_price')}) = price_tier, false)",
    "total_value": f"NOT coalesce(abs({O.r2('final_price * quantity')} - total_value) <= {TOL}, false)",
    "own_price_band": (f"NOT coalesce(final_price BETWEEN base_price * CAST(0.9 AS DOUBLE) - {TOL} "
                       f"AND base_price * CAST(1.06 AS DOUBLE) + {TOL}, false)"),
    "discount_profile": f"({O.discount_bucket_sql()}) IS NULL",
    "quantity_domain": ("NOT coalesce(quantity IS NOT NULL AND quantity >= 1 AND "
                        "CASE WHEN category = 'SMALL' THEN quantity <= 4 ELSE quantity <= 5 END, false)"),
    "city_in_region": "NOT EXISTS (SELECT 1 FROM geo WHERE geo.region = g.region AND geo.city = g.city)",
    "payment_domain": ("NOT EXISTS (SELECT 1 FROM pay_w WHERE pay_w.price_tier = g.price_tier "
                       "AND pay_w.payment_method = g.payment_method)"),
    "segment_domain": "NOT EXISTS (SELECT 1 FROM seg_w WHERE seg_w.customer_segment = g.customer_segment)",
    "event_type": "NOT coalesce(event_type = 'order_placed', false)",
}
_P_RULES = {
    "price_diff": f"NOT coalesce(abs({O.r2('p.our_price - p.competitor_price')} - p.price_diff) <= {TOL}, false)",
    "price_diff_pct": ("NOT coalesce((p.price_diff_pct IS NULL AND pct_re IS NULL) OR "
                       f"abs(pct_re - p.price_diff_pct) <= {TOL}, false)"),
    "competitor_band": "NOT coalesce(p.competitor_price BETWEEN lo AND hi, false)",
    "unknown_competitor": "comp_missing",
    "event_type": "NOT coalesce(p.event_type = 'price_update', false)",
}


def _contract_sql() -> str:
    o_cols = ", ".join(f"({v}) AS {k}" for k, v in _O_RULES.items())
    p_cols = ", ".join(f"({v}) AS {k}" for k, v in _P_RULES.items())
    body = (f", o_rules AS (SELECT {o_cols} FROM good g), "
            "p_base AS (SELECT p.*, pr.base_price AS base, c.competitor IS NULL AS comp_missing, "
            f"{O.tier_sql('pr.base_price')} AS tier, c.budget_aggression AS b, c.premium_aggression AS pa, "
            "CASE WHEN p.our_price = 0 THEN NULL ELSE " + O.r2("p.price_diff / p.our_price * 100") + " END AS pct_re "
            "FROM pricing_parsed p LEFT JOIN product pr ON p.product_id = pr.product_id "
            "LEFT JOIN comp c ON p.competitor = c.competitor), "
            "p_band AS (SELECT *, base * (CASE WHEN tier = 'budget' THEN b WHEN tier = 'premium' THEN pa "
            f"ELSE (b + pa) / 2 END) - {TOL} AS lo, base * (CASE WHEN tier = 'budget' THEN CAST(1.05 AS DOUBLE) "
            "WHEN tier = 'premium' THEN CAST(1.02 AS DOUBLE) ELSE CAST(1.04 AS DOUBLE) END) + "
            f"{TOL} AS hi FROM p_base), "
            f"p_rules AS (SELECT {p_cols} FROM p_band p) ")
    selects = [f"SELECT 'orders' AS table_name, (SELECT count(*) FROM o_rules) AS n, '{k}' AS rule, "
               f"count(*) FILTER (WHERE {k}) AS violations FROM o_rules" for k in _O_RULES]
    selects += [f"SELECT 'pricing_events', (SELECT count(*) FROM p_rules), '{k}', count(*) FILTER (WHERE {k}) "
                "FROM p_rules" for k in _P_RULES]
    return O.with_dims(body + " UNION ALL ".join(selects), pricing=True)


@register("contract_audit", _contract_sql())
def contract_audit(spark, sf_dir):
    """Q1: event contract, one violation count per rule and table."""
    return audits.contract_audit(spark, sf_dir, _orders(spark, sf_dir), _pricing(spark, sf_dir))


_MIX_SQL = """
, obs AS (
  SELECT 'region' AS dimension, 'all' AS parent, region AS key, count(*) AS n FROM good GROUP BY region
  UNION ALL SELECT 'product', 'all', product_id, count(*) FROM good GROUP BY product_id
  UNION ALL SELECT 'segment', 'all', customer_segment, count(*) FROM good GROUP BY customer_segment
  UNION ALL SELECT 'payment_method', price_tier, payment_method, count(*) FROM good GROUP BY price_tier, payment_method
  UNION ALL SELECT 'quantity', CASE WHEN category = 'SMALL' THEN 'limited' ELSE 'default' END,
                   CAST(quantity AS VARCHAR), count(*) FROM good GROUP BY 2, 3),
wts AS (
  SELECT 'region' AS dimension, 'all' AS parent, region AS key, weight FROM region_w
  UNION ALL SELECT 'product', 'all', product_id, weight FROM product
  UNION ALL SELECT 'segment', 'all', customer_segment, weight FROM seg_w
  UNION ALL SELECT 'payment_method', price_tier, payment_method, weight FROM pay_w
  UNION ALL SELECT 'quantity', CASE WHEN is_limited THEN 'limited' ELSE 'default' END, CAST(quantity AS VARCHAR),
                   weight FROM qty_w),
f AS (
  SELECT coalesce(o.dimension, w.dimension) AS dimension, coalesce(o.parent, w.parent) AS parent,
         coalesce(o.key, w.key) AS key, o.n, w.weight
  FROM obs o FULL OUTER JOIN wts w ON o.dimension = w.dimension AND o.parent = w.parent AND o.key = w.key),
ot AS (SELECT dimension, parent, sum(n) AS n_tot FROM obs GROUP BY 1, 2),
wt AS (SELECT dimension, parent, sum(weight) AS w_tot FROM wts GROUP BY 1, 2)
SELECT f.dimension, f.parent, f.key, coalesce(f.n, 0) AS n, coalesce(f.n / ot.n_tot, 0.0) AS share,
       f.weight / wt.w_tot AS weight_share, abs(coalesce(f.n / ot.n_tot, 0.0) - f.weight / wt.w_tot) AS abs_diff
FROM f LEFT JOIN ot ON f.dimension = ot.dimension AND f.parent = ot.parent
LEFT JOIN wt ON f.dimension = wt.dimension AND f.parent = wt.parent"""


@register("mix_audit", O.with_dims(_MIX_SQL))
def mix_audit(spark, sf_dir):
    """Q2: observed shares vs configured weights."""
    return audits.mix_audit(spark, sf_dir, _orders(spark, sf_dir))


@register("return_rate_audit", O.with_dims(
    ", rr AS (SELECT g.brand, count(*) AS n, count(*) FILTER (WHERE g.is_returned) AS n_returned, "
    "coalesce(b.rate, CAST(0.08 AS DOUBLE)) AS expected_rate FROM good g LEFT JOIN brand_ret b "
    "ON g.brand = b.brand GROUP BY g.brand, b.rate) "
    "SELECT brand, n, n_returned, n_returned / n AS observed_rate, expected_rate, "
    "abs(n_returned / n - expected_rate) AS abs_diff FROM rr"))
def return_rate_audit(spark, sf_dir):
    """Q3"""
    return audits.return_rate_audit(spark, sf_dir, _orders(spark, sf_dir))


@register("competitor_audit", O.with_dims(
    ", obs AS (SELECT competitor, count(*) AS n, count(*) FILTER (WHERE in_stock) AS n_in_stock "
    "FROM pricing_parsed GROUP BY competitor), "
    "j AS (SELECT coalesce(o.competitor, c.competitor) AS competitor, o.n, o.n_in_stock, c.stock_rate, "
    "c.price_change_pct FROM obs o FULL OUTER JOIN comp c ON o.competitor = c.competitor) "
    "SELECT competitor, coalesce(n, 0) AS n, coalesce(n_in_stock, 0) AS n_in_stock, n_in_stock / n AS in_stock_rate, "
    "stock_rate, CASE WHEN price_change_pct IS NOT NULL THEN coalesce(n, 0) / "
    "sum(CASE WHEN price_change_pct IS NOT NULL THEN n END) OVER () END AS event_share, "
    "price_change_pct / sum(price_change_pct) OVER () AS expected_share FROM j", pricing=True))
def competitor_audit(spark, sf_dir):
    """Q4"""
    return audits.competitor_audit(spark, _pricing(spark, sf_dir))


# ---- JSON, coercion, intervals, publishing -------------------------------------------

@register("event_props_json",
          "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def event_props_json(spark, sf_dir):
    """P2 on the ``events.props`` JSON text."""
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


@register("json_roundtrip", O.with_dims("SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_mismatch FROM good"))
def json_roundtrip(spark, sf_dir):
    """P10 + P11 + P2: landed orders -> JSON (microsecond ISO timestamps,
    explicit nulls) -> parsed back with the fixed schema; every field must
    come back equal (NULL-safe)."""
    o = _orders(spark, sf_dir).drop("event_date")
    text = to_json_value([to_iso_text(F.col(f)).alias(f) if f == "timestamp" else F.col(f)
                          for f in ORDER_FIELDS])
    back = (o.withColumn("_json", F.from_json(text.cast("string"), ORDERS))
            .withColumn("_ts", F.try_to_timestamp(F.col("_json.timestamp")).cast("timestamp_ntz")))
    same = F.lit(True)
    for f in ORDER_FIELDS:
        other = F.col("_ts") if f == "timestamp" else F.col(f"_json.{f}")
        same = same & F.col(f).eqNullSafe(other)
    return back.agg(F.count(F.lit(1)).alias("n"), F.count_if(~same).alias("n_mismatch"))


@register("boolean_coercion", O.with_events(
    "SELECT is_returned, count(*) AS n FROM orders_parsed GROUP BY 1"))
def boolean_coercion(spark, sf_dir):
    """The boolean field read as text and cast explicitly."""
    recs = records(spark, sf_dir, ORDERS_TOPIC)
    text = F.from_json(F.col("value").cast("string"), "is_returned string").getField("is_returned")
    return (recs.select(text.cast("boolean").alias("is_returned"))
            .groupBy("is_returned").agg(F.count(F.lit(1)).alias("n")))


_AS_TEXT = "CASE pmod(offset, 4) WHEN 1 THEN '\"$1\"' WHEN 3 THEN '\"maybe\"' ELSE '$1' END"


@register("boolean_coercion_mixed", O.with_events(
    "SELECT CASE WHEN \"offset\" % 4 = 3 THEN NULL ELSE is_returned END AS is_returned, "
    "\"offset\" % 4 = 3 AND is_returned IS NOT NULL AS not_boolean, count(*) AS n FROM orders_parsed GROUP BY 1, 2"))
def boolean_coercion_mixed(spark, sf_dir):
    """P9 where the producer writes booleans as text, as 0 and 1, or as another
    word (by the record's offset): coerced, or bad with a reason."""
    recs = records(spark, sf_dir, ORDERS_TOPIC)
    text = F.regexp_replace(F.col("value").cast("string"), F.lit('(?<="is_returned":)(true|false)'), F.expr(_AS_TEXT))
    numbers = F.replace(F.replace(text, F.lit('"is_returned":true'), F.lit('"is_returned":1')), F.lit('"is_returned":false'), F.lit('"is_returned":0'))
    mixed = recs.withColumn("value", F.when(F.col("offset") % 4 == 2, numbers).otherwise(text).cast("binary"))
    flagged = coerce_booleans(orders_flagged(mixed))
    return (flagged.groupBy("is_returned", F.array_contains("quality_reasons", "is_returned_not_boolean").alias("not_boolean"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("day_offset", O.with_dims(
    ", pd AS (SELECT CAST(\"timestamp\" AS DATE) AS d, count(*) AS n FROM good GROUP BY 1), "
    "b AS (SELECT d, n, CAST(date_diff('day', d, max(d) OVER ()) // 30 AS INTEGER) AS bucket, "
    "CAST(max(d) OVER () - INTERVAL 180 DAY AS DATE) AS window_start FROM pd) "
    "SELECT bucket, min(d) AS first_day, max(d) AS last_day, count(*) AS n_days, CAST(sum(n) AS BIGINT) AS n, "
    "count(*) FILTER (WHERE d > window_start) AS n_days_in_window FROM b GROUP BY 1"))
def day_offset(spark, sf_dir):
    """P13 + A5: days counted back from the last landed day in 30-day steps
    (the backfill's progress unit), and whether each day lies within the
    last 180 days (interval arithmetic). The window runs over days only."""
    per_day = _orders(spark, sf_dir).groupBy(F.to_date("timestamp").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    last = F.max("d").over(Window.partitionBy())      # over the per-day rows only
    b = (per_day.withColumn("bucket", F.floor(F.datediff(last, F.col("d")) / 30).cast("int"))
         .withColumn("window_start", F.date_sub(last, 180)))
    return b.groupBy("bucket").agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"),
                                   F.count(F.lit(1)).alias("n_days"), F.sum("n").alias("n"),
                                   F.count_if(F.col("d") > F.col("window_start")).alias("n_days_in_window"))


@register("kafka_publish_records", O.with_dims(f"SELECT true AS key_is_null, {O.ORDER_COLS} FROM good"))
def kafka_publish_records(spark, sf_dir):
    """K4 + P10: landed orders in the Kafka sink's shape (key, value), each
    field read back from the value."""
    sent = kafka_records_for(_orders(spark, sf_dir), ORDER_FIELDS)
    back = sent.select("key", F.from_json(F.col("value").cast("string"), ORDERS).alias("e"))
    return back.select(F.col("key").isNull().alias("key_is_null"), *(
        F.try_to_timestamp(F.col("e.timestamp")).cast("timestamp_ntz").alias(f) if f == "timestamp" else F.col(f"e.{f}").alias(f)
        for f in ORDER_FIELDS))
