"""Dimension tables and lookups (section 1.3; J1-J5, D7, D8).

Dimensions are DataFrames derived by rule from the base tables, never
driver-side dicts. Lookups are joins. A dimension is broadcast explicitly
only when its size is bounded by construction (a fixed list, the 5
regions and 25 nations of the schema); dimensions whose size follows the
data (products come from ``part``) are left to Spark's size-checked
automatic broadcast, which falls back to a sort-merge join when the
table is large.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import work_root
from ..functions.business import CENT_TOLERANCE
from ..sources.tables import read_table

# ---- fixed values ----------------------------------------------------------
DEFAULT_RETURN_RATE = 0.08
# default discount profile: (lo, hi, weight); the first bucket is "no discount"
DEFAULT_DISCOUNT_BUCKETS = [(0.0, 0.0, 20), (2.0, 10.0, 30), (10.0, 20.0, 30), (20.0, 35.0, 20)]
NO_PROFILE_CATEGORY = "LARGE"
COMPETITOR_COUNT = 5
TIERS = ["budget", "mid", "premium"]
PAYMENT_METHODS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
# quantity mix: the limited category takes 1-4, the others 1-5
LIMITED_QTY_CATEGORY = "SMALL"
QTY_WEIGHTS_LIMITED = [50, 30, 12, 8]
QTY_WEIGHTS_DEFAULT = [60, 25, 8, 4, 3]
SPIKE_CATEGORIES = ["ECONOMY", "PROMO", "SMALL"]
# competitor bands: budget [b, 1.05], premium [p, 1.02], mid [(b+p)/2, 1.04]
BAND_TOP = {"budget": 1.05, "mid": 1.04, "premium": 1.02}
# ---------------------------------------------------------------------------

def literal_rows(spark: SparkSession, rows, columns) -> DataFrame:
    """A small fixed table built JVM-side from literals (no Python worker
    runs): ``columns`` is a list of (name, type)."""
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, columns)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


BROADCAST_ROWS = 100_000   # a dimension row is at most a few hundred bytes


def sized(dim: DataFrame) -> DataFrame:
    """A dimension derived from a large table, materialised so that its own
    size is known (an aggregate over ``part`` is planned by the size of
    ``part``): broadcast if it is small, so the fact is not shuffled on a few
    hot keys, and left to the planner otherwise."""
    spark = dim.sparkSession
    path = f"{work_root(spark)}/dims/{uuid.uuid4().hex[:12]}"
    dim.write.parquet(path)
    table = spark.read.schema(dim.schema).parquet(path)
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def coded(df: DataFrame, cols: list, code: str) -> tuple:
    """For text columns of ``df`` that take few combinations: the functions that put a
    number ``code`` in their place and that put them back. Both leave rows as they
    are if there are many combinations. A shuffle between the two moves less."""
    path = f"{work_root(df.sparkSession)}/dims/{uuid.uuid4().hex[:12]}"
    df.select(*cols).distinct().withColumn(code, F.monotonically_increasing_id()).write.parquet(path)
    dim = df.sparkSession.read.parquet(path)
    if dim.count() > BROADCAST_ROWS:
        return (lambda rows: rows), (lambda rows: rows)
    keys = F.broadcast(dim.select(code, *(F.col(c).alias(f"{code}_{c}") for c in cols)))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"{code}_{c}")) for c in cols))
    return ((lambda rows: rows.join(keys, same).select(*(c for c in rows.columns if c not in cols), code)),
            (lambda rows: rows.join(F.broadcast(dim), code, "left").drop(code)))


def product_id(partkey: str) -> Column:
    return F.concat(F.lit("PRD-"), F.col(partkey).cast("string"))


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product catalog from ``part``: one row per part."""
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey"),
        product_id("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        (F.col("p_retailprice") * (F.col("p_partkey") % 40 + 1)).alias("base_price"),
        (F.col("p_partkey") % 16 + 1).cast("int").alias("weight"),
    )


def brand_return_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand -> return rate: even-numbered brands only (the rest take the
    default); rate = 0.03 + (number % 11) / 100."""
    brands = read_table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand")).distinct()
    num = F.regexp_extract("brand", r"#(\d+)$", 1).cast("int")
    return (brands.where(num % 2 == 0)
            .select("brand", (F.lit(3) + num % 11).alias("_pct"))
            .select("brand", (F.col("_pct") / 100).alias("rate")))


def return_rate(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Lookup with a scalar default."""
    return (df.join(sized(dim), "brand", "left")
            .withColumn("rate", F.coalesce(F.col("rate"), F.lit(DEFAULT_RETURN_RATE))))


def discount_profile_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category -> array of (lo, hi, weight) buckets, every category but one
    (which falls back to the default profile). Ranges by rule of the name
    length L, so that categories differ."""
    cats = read_table(spark, sf_dir, "part").select(F.col("p_type").alias("category")).distinct()
    L = F.length("category")
    small_hi = F.lit(8) + (L % 2) * 2
    med_hi = F.lit(20) + (L % 2) * 5
    large_hi = F.lit(30) + (L % 4) * 5
    w0 = F.lit(10) + (L % 3) * 5
    w1 = F.lit(20) + (L % 2) * 5
    w2 = F.lit(35)
    w3 = F.lit(100) - w0 - w1 - w2

    def b(lo, hi, w):
        return F.struct(lo.cast("double").alias("lo"), hi.cast("double").alias("hi"),
                        w.cast("int").alias("weight"))

    buckets = F.array(b(F.lit(0), F.lit(0), w0), b(F.lit(2), small_hi, w1),
                      b(small_hi, med_hi, w2), b(med_hi, large_hi, w3))
    return cats.where(F.col("category") != NO_PROFILE_CATEGORY).select("category", buckets.alias("buckets"))


def default_buckets() -> Column:
    return F.array(*[F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), F.lit(w).alias("weight"))
                     for lo, hi, w in DEFAULT_DISCOUNT_BUCKETS])


def with_discount_profile(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Lookup with a record default."""
    return (df.join(sized(dim), "category", "left")
            .withColumn("buckets", F.coalesce(F.col("buckets"), default_buckets())))


def discount_bucket(discount="discount_percent", buckets="buckets") -> Column:
    """Index of the bucket holding the discount. 0 is bucket 0; ranges
    touch, so a boundary value goes to the lower bucket; outside every
    range -> NULL."""
    d = F.col(discount) if isinstance(discount, str) else discount
    idx = F.transform(F.col(buckets), lambda b, i: F.when(
        ((i == 0) & (d == 0)) | ((i > 0) & (d >= b["lo"]) & (d <= b["hi"])), i))
    return F.array_min(idx)


def competitor_dim(spark: SparkSession) -> DataFrame:
    """Competitor behaviour profile, 5 rows by rule of the index i.
    Percent integers / 100 so every engine gets the same doubles."""
    rows = spark.range(COMPETITOR_COUNT).select(
        F.concat(F.lit("COMP_"), F.col("id").cast("string")).alias("competitor"),
        ((F.lit(80) + F.col("id") * 3) / 100).alias("budget_aggression"),
        ((F.lit(93) + F.col("id")) / 100).alias("premium_aggression"),
        ((F.lit(40) - F.col("id") * 5) / 100).alias("price_change_freq"),
        (F.lit(40) - F.col("id") * 5).cast("int").alias("price_change_pct"),
        ((F.lit(92) - F.col("id") * 4) / 100).alias("stock_rate"),
    )
    return rows


def competitor_band(base_price="base_price", tier="price_tier") -> tuple[Column, Column]:
    """Expected competitor price band by tier (needs competitor_dim
    columns joined)."""
    base, t = F.col(base_price), F.col(tier)
    lo_factor = (F.when(t == "budget", F.col("budget_aggression"))
                 .when(t == "premium", F.col("premium_aggression"))
                 .otherwise((F.col("budget_aggression") + F.col("premium_aggression")) / 2))
    hi_factor = (F.when(t == "budget", BAND_TOP["budget"])
                 .when(t == "premium", BAND_TOP["premium"])
                 .otherwise(BAND_TOP["mid"]))
    return base * lo_factor - CENT_TOLERANCE, base * hi_factor + CENT_TOLERANCE


def geo_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation -> (city, region) rows; 25 x 5 rows by the schema, so it is
    safe to broadcast."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
                       .select("n_nationkey", F.col("n_name").alias("city"),
                               F.col("r_name").alias("region"), "r_regionkey"))


def region_city_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region -> (cities, weight) rows; weight = 10 + 5 * regionkey."""
    g = geo_dim(spark, sf_dir)
    return (g.groupBy("region", "r_regionkey")
            .agg(F.array_sort(F.collect_list("city")).alias("cities"))
            .select("region", "cities", (F.lit(10) + F.col("r_regionkey") * 5).cast("int").alias("weight")))


def region_city_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mapping in its nested form, one row holding
    MAP<region, STRUCT<cities, weight>> (bounded: one entry per region)."""
    d = region_city_dim(spark, sf_dir)
    return d.agg(F.map_from_entries(F.collect_list(
        F.struct("region", F.struct("cities", "weight")))).alias("region_city"))


def region_city_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hierarchy exploded to (region, city) rows."""
    return region_city_dim(spark, sf_dir).select("region", F.explode("cities").alias("city"))


def payment_mix_weight(tier: str, rank: int) -> int:
    """Weight of the payment method of rank 1..5 within a tier; each tier
    sums to 100: budget 30..10, mid 20 each, premium 10..30."""
    return {"budget": 35 - 5 * rank, "mid": 20, "premium": 5 + 5 * rank}[tier]


def payment_mix_dim(spark: SparkSession) -> DataFrame:
    """Tier -> payment method -> weight, 3 x 5 rows built from the rule."""
    rows = [(t, m, payment_mix_weight(t, i + 1)) for t in TIERS for i, m in enumerate(PAYMENT_METHODS)]
    return literal_rows(spark, rows, [("price_tier", "string"), ("payment_method", "string"), ("weight", "int")])


def segment_mix_dim(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, [(s, 20) for s in SEGMENTS], [("customer_segment", "string"), ("weight", "int")])


def quantity_mix_dim(spark: SparkSession) -> DataFrame:
    rows = [(True, q + 1, w) for q, w in enumerate(QTY_WEIGHTS_LIMITED)]
    rows += [(False, q + 1, w) for q, w in enumerate(QTY_WEIGHTS_DEFAULT)]
    return literal_rows(spark, rows, [("is_limited", "boolean"), ("quantity", "int"), ("weight", "int")])


def region_weight_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_city_dim(spark, sf_dir).select("region", "weight")


def with_product(df: DataFrame, products: DataFrame, cols=("base_price",)) -> DataFrame:
    """Attach product attributes (as ``dim_<name>``) to events by
    product id (stream-static or batch)."""
    right = products.select("product_id", *[F.col(c).alias(f"dim_{c}") for c in cols])
    return df.join(right, "product_id", "left")
