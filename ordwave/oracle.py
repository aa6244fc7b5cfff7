"""Expected results as ANSI SQL over the base tables (DuckDB dialect).

The oracle never goes through JSON: it recomputes the events and the
parse outcome of every defect class straight from the base tables, so it
is an independent path to the answer each Spark query must give.
"""

from __future__ import annotations

# ---- the events, typed, with their defect class -----------------------------

_BASE = """
geo AS (
  SELECT n.n_nationkey, n.n_name AS city, r.r_name AS region, r.r_regionkey
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
product AS (
  SELECT p_partkey, 'PRD-' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         p_type AS category, p_brand AS brand,
         p_retailprice * (p_partkey % 40 + 1) AS base_price,
         CAST(p_partkey % 16 + 1 AS INTEGER) AS weight
  FROM part),
ev AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
         l.l_shipdate, l.l_discount, l.l_returnflag, l.l_linestatus,
         o.o_orderdate, o.o_orderpriority, c.c_mktsegment, g.city, g.region,
         p.product_id, p.product_name, p.category, p.brand, p.base_price,
         l.l_orderkey * 8 + l.l_linenumber AS k,
         o.o_orderdate + to_microseconds(((l.l_orderkey * 8 + l.l_linenumber) * 37) % 82800 * 1000000
                                          + (l.l_orderkey * 8 + l.l_linenumber) % 1000000) AS event_ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN geo g ON c.c_nationkey = g.n_nationkey
  JOIN product p ON l.l_partkey = p.p_partkey)"""


def r2(x: str) -> str:
    return f"(floor(({x}) * 100 + 0.5) / 100)"


_TOTAL_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate"

_ORDER_ID = ("'ORD-' || chr(CAST(65 + l_linenumber AS INTEGER)) || chr(CAST(65 + l_orderkey % 26 AS INTEGER))"
             " || lpad(CAST((l_orderkey // 26) % 10000 AS VARCHAR), 4, '0')"
             " || chr(CAST(65 + l_partkey % 26 AS INTEGER)) || chr(CAST(65 + l_suppkey % 26 AS INTEGER))"
             " || lpad(CAST(l_partkey % 10000 AS VARCHAR), 4, '0')")

_ORD = f"""
ord0 AS (
  SELECT *,
    CASE WHEN k % 59 = 0 THEN 'tombstone' WHEN k % 97 = 0 THEN 'truncated'
         WHEN k % 89 = 0 THEN 'order_id_null' WHEN k % 83 = 0 THEN 'product_id_absent'
         WHEN k % 79 = 0 THEN 'timestamp_bad' WHEN k % 67 = 0 THEN 'timestamp_absent'
         WHEN k % 73 = 0 THEN 'order_id_empty' WHEN k % 71 = 0 THEN 'final_price_zero'
         WHEN k % 61 = 0 THEN 'quantity_text' ELSE 'none' END AS defect,
    CASE WHEN k % 101 = 0 THEN {r2("base_price * CAST(1.2 AS DOUBLE)")}
         ELSE {r2("base_price * (CAST(0.9 AS DOUBLE) + CAST(k % 17 AS DOUBLE) / 100)")} END AS fp,
    CAST(CAST(floor(l_quantity) AS BIGINT) % 5 + 1 AS INTEGER) AS qty,
    {_ORDER_ID} AS oid
  FROM ev),
ord_rec AS (
  SELECT *, CAST(k % 3 AS INTEGER) AS kpart,
    row_number() OVER (PARTITION BY k % 3 ORDER BY {_TOTAL_ORDER}, copy_no) - 1 AS off
  FROM (SELECT *, 1 AS copy_no FROM ord0 UNION ALL SELECT *, 2 AS copy_no FROM ord0 WHERE k % 50 = 0)),
orders_parsed AS (
  SELECT
    CASE WHEN dead THEN NULL ELSE 'order_placed' END AS event_type,
    CASE WHEN dead OR defect = 'order_id_null' THEN NULL WHEN defect = 'order_id_empty' THEN ''
         ELSE oid END AS order_id,
    CASE WHEN dead OR defect = 'product_id_absent' THEN NULL ELSE product_id END AS product_id,
    CASE WHEN dead THEN NULL ELSE product_name END AS product_name,
    CASE WHEN dead THEN NULL ELSE category END AS category,
    CASE WHEN dead THEN NULL ELSE brand END AS brand,
    CASE WHEN dead THEN NULL WHEN base_price < 5000 THEN 'budget' WHEN base_price < 25000 THEN 'mid'
         ELSE 'premium' END AS price_tier,
    CASE WHEN dead THEN NULL ELSE base_price END AS base_price,
    CASE WHEN dead THEN NULL WHEN defect = 'final_price_zero' THEN CAST(0 AS DOUBLE) ELSE fp END AS final_price,
    CASE WHEN dead THEN NULL
         ELSE CAST(CAST(floor(l_discount * 100 + 0.5) AS BIGINT) * (l_linenumber % 5 + 1) AS DOUBLE)
         END AS discount_percent,
    CASE WHEN dead OR defect = 'quantity_text' THEN NULL ELSE qty END AS quantity,
    CASE WHEN dead THEN NULL ELSE {r2("fp * qty")} END AS total_value,
    CASE WHEN dead THEN NULL ELSE region END AS region,
    CASE WHEN dead THEN NULL ELSE city END AS city,
    CASE WHEN dead THEN NULL ELSE o_orderpriority END AS payment_method,
    CASE WHEN dead THEN NULL ELSE c_mktsegment END AS customer_segment,
    CASE WHEN dead THEN NULL ELSE l_returnflag = 'R' END AS is_returned,
    CASE WHEN dead OR defect IN ('timestamp_bad', 'timestamp_absent') THEN NULL ELSE event_ts END AS "timestamp",
    CASE WHEN dead THEN NULL WHEN defect = 'timestamp_bad' THEN 'not-a-time'
         WHEN defect = 'timestamp_absent' THEN NULL ELSE 'ok' END AS ts_text_kind,
    'orders-topic' AS topic, kpart AS "partition", off AS "offset",
    TIMESTAMP '2024-07-01 00:00:00' + to_milliseconds(off) AS kafka_timestamp,
    defect, k, copy_no
  FROM (SELECT *, defect IN ('tombstone', 'truncated') AS dead FROM ord_rec)),
orders_flagged AS (
  SELECT *,
    (order_id IS NULL OR product_id IS NULL OR "timestamp" IS NULL) AS bad_nulls,
    (order_id IS NULL OR order_id = '' OR product_id IS NULL OR product_id = '' OR category IS NULL
     OR category = '' OR final_price IS NULL OR final_price = 0 OR region IS NULL OR region = ''
     OR "timestamp" IS NULL) AS bad_strict
  FROM orders_parsed)"""

_PRI = f"""
pri0 AS (
  SELECT *,
    CASE WHEN k % 76 = 0 THEN 'truncated' WHEN k % 116 = 0 THEN 'price_diff_absent'
         WHEN k % 92 = 0 THEN 'price_diff_null' WHEN k % 84 = 0 THEN 'our_price_zero'
         ELSE 'none' END AS defect,
    {r2("base_price * (CAST(0.85 AS DOUBLE) + CAST((k // 4) % 21 AS DOUBLE) / 100)")} AS cp
  FROM ev),
pri1 AS (
  SELECT *, CASE WHEN defect = 'our_price_zero' THEN CAST(0 AS DOUBLE)
                 ELSE {r2("base_price * (CAST(0.9 AS DOUBLE) + CAST(k % 17 AS DOUBLE) / 100)")} END AS op
  FROM pri0),
pri2 AS (
  SELECT *, {r2("op - cp")} AS pd,
    CAST(l_orderkey % 2 AS INTEGER) AS kpart,
    row_number() OVER (PARTITION BY l_orderkey % 2 ORDER BY {_TOTAL_ORDER}) - 1 AS off
  FROM pri1),
pricing_parsed AS (
  SELECT
    CASE WHEN dead THEN NULL ELSE 'price_update' END AS event_type,
    CASE WHEN dead THEN NULL ELSE product_id END AS product_id,
    CASE WHEN dead THEN NULL ELSE product_name END AS product_name,
    CASE WHEN dead THEN NULL ELSE category END AS category,
    CASE WHEN dead THEN NULL ELSE brand END AS brand,
    CASE WHEN dead THEN NULL ELSE 'COMP_' || CAST(l_suppkey % 6 AS VARCHAR) END AS competitor,
    CASE WHEN dead THEN NULL ELSE cp END AS competitor_price,
    CASE WHEN dead THEN NULL ELSE op END AS our_price,
    CASE WHEN dead OR defect IN ('price_diff_absent', 'price_diff_null') THEN NULL ELSE pd END AS price_diff,
    CASE WHEN dead OR op = 0 THEN NULL ELSE {r2("pd / op * 100")} END AS price_diff_pct,
    CASE WHEN dead THEN NULL ELSE l_linestatus = 'F' END AS in_stock,
    CASE WHEN dead THEN NULL ELSE event_ts END AS "timestamp",
    'pricing-topic' AS topic, kpart AS "partition", off AS "offset",
    TIMESTAMP '2024-07-01 00:00:00' + to_milliseconds(off) AS kafka_timestamp,
    defect, k, base_price AS true_base_price
  FROM (SELECT *, defect = 'truncated' AS dead FROM pri2))"""


def with_events(body: str, orders: bool = True, pricing: bool = False) -> str:
    parts = [_BASE]
    if orders:
        parts.append(_ORD)
    if pricing:
        parts.append(_PRI)
    return "WITH " + ",".join(parts) + "\n" + body


ORDER_COLS = ("event_type, order_id, product_id, product_name, category, brand, price_tier, base_price, "
              "final_price, discount_percent, quantity, total_value, region, city, payment_method, "
              "customer_segment, is_returned, \"timestamp\"")
PRICING_COLS = ("event_type, product_id, product_name, category, brand, competitor, competitor_price, "
                "our_price, price_diff, price_diff_pct, in_stock, \"timestamp\"")
KAFKA_COLS = 'topic, "partition", "offset", kafka_timestamp'

TOL = "CAST(0.010000001 AS DOUBLE)"

_DIMS = """
good AS (SELECT * FROM orders_flagged WHERE NOT bad_nulls),
brand_ret AS (
  SELECT brand, CAST(3 + num % 11 AS DOUBLE) / 100 AS rate
  FROM (SELECT DISTINCT p_brand AS brand, CAST(regexp_extract(p_brand, '#(\\d+)$', 1) AS INTEGER) AS num FROM part)
  WHERE num % 2 = 0),
comp AS (
  SELECT 'COMP_' || CAST(i AS VARCHAR) AS competitor, CAST(80 + 3 * i AS DOUBLE) / 100 AS budget_aggression,
         CAST(93 + i AS DOUBLE) / 100 AS premium_aggression, CAST(40 - 5 * i AS DOUBLE) / 100 AS price_change_freq,
         CAST(40 - 5 * i AS INTEGER) AS price_change_pct, CAST(92 - 4 * i AS DOUBLE) / 100 AS stock_rate
  FROM range(5) t(i)),
region_w AS (SELECT r_name AS region, CAST(10 + 5 * r_regionkey AS INTEGER) AS weight FROM region
             WHERE r_regionkey IN (SELECT n_regionkey FROM nation)),
pay_w AS (
  SELECT t.tier AS price_tier, m.pm AS payment_method,
         CAST(CASE WHEN t.tier = 'budget' THEN 35 - 5 * m.p WHEN t.tier = 'mid' THEN 20 ELSE 5 + 5 * m.p END
              AS INTEGER) AS weight
  FROM (VALUES ('budget'), ('mid'), ('premium')) t(tier),
       (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 4), ('5-LOW', 5)) m(pm, p)),
seg_w AS (SELECT * FROM (VALUES ('AUTOMOBILE', 20), ('BUILDING', 20), ('FURNITURE', 20), ('HOUSEHOLD', 20),
                                ('MACHINERY', 20)) s(customer_segment, weight)),
qty_w AS (SELECT * FROM (VALUES (true, 1, 50), (true, 2, 30), (true, 3, 12), (true, 4, 8), (false, 1, 60),
                                (false, 2, 25), (false, 3, 8), (false, 4, 4), (false, 5, 3)) q(is_limited, quantity, weight))"""


def discount_bucket_sql(d: str = "discount_percent", cat: str = "category") -> str:
    L = f"length({cat})"
    h1, h2, h3 = f"(8 + 2 * ({L} % 2))", f"(20 + 5 * ({L} % 2))", f"(30 + 5 * ({L} % 4))"
    return (f"CASE WHEN {cat} = 'LARGE' OR {cat} IS NULL THEN (CASE WHEN {d} = 0 THEN 0 WHEN {d} >= 2 AND {d} <= 10 "
            f"THEN 1 WHEN {d} >= 10 AND {d} <= 20 THEN 2 WHEN {d} >= 20 AND {d} <= 35 THEN 3 END) "
            f"ELSE (CASE WHEN {d} = 0 THEN 0 WHEN {d} >= 2 AND {d} <= {h1} THEN 1 WHEN {d} >= {h1} AND {d} <= {h2} "
            f"THEN 2 WHEN {d} >= {h2} AND {d} <= {h3} THEN 3 END) END")


def tier_sql(base: str) -> str:
    return (f"CASE WHEN {base} < 5000 THEN 'budget' WHEN {base} < 25000 THEN 'mid' "
            f"WHEN {base} IS NOT NULL THEN 'premium' END")


def with_dims(body: str, pricing: bool = False) -> str:
    return "WITH " + ",".join([_BASE, _ORD] + ([_PRI] if pricing else []) + [_DIMS]) + "\n" + body
