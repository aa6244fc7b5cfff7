"""a merge shuffles texts of few values as numbers, and puts back what was there."""

import pytest
from pyspark.sql import functions as F

from ordwave.operators import dims
from ordwave.plans import landing
from ordwave.schemas import landing_schema


@pytest.mark.parametrize("most", [100_000, 2])
def test_merged_rows_are_the_rows(spark, tmp_path, monkeypatch, most):
    """NULL and empty texts, NaN, rows that come twice; with more values than are coded (2), texts are moved."""
    monkeypatch.setattr(dims, "BROADCAST_ROWS", most)
    schema = landing_schema("orders").rsplit(", ", 1)[0]
    made = spark.range(60).select(F.col("id").alias("offset"), F.timestamp_seconds(F.col("id") * 7919 % 60 * 9000).cast("timestamp_ntz").alias("timestamp"),
                                  F.element_at(F.array(F.lit(None), F.lit(""), F.lit("ASIA")), (F.col("id") % 3 + 1).cast("int")).alias("region"),
                                  F.when(F.col("id") % 4 > 0, F.lit(float("nan"))).alias("discount_percent"), F.lit("s-1").alias("batch"))
    made = made.withColumn("event_date", F.to_date("timestamp")).unionByName(made.where("offset < 5").withColumn("event_date", F.to_date("timestamp")))
    fields = spark.createDataFrame([], schema).schema
    df = made.select(*((F.col(f.name) if f.name in made.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))
    df.write.parquet(f"{tmp_path}/in")
    df = spark.read.schema(schema).parquet(f"{tmp_path}/in")
    moved = []
    ranged = type(df).repartitionByRange
    monkeypatch.setattr(type(df), "repartitionByRange", lambda self, *a: moved.append(self.columns) or ranged(self, *a))
    files = landing._merge(spark, df, "good", f"{tmp_path}/out", 3, 1 << 20, 65)
    out = spark.read.schema(schema).parquet(f"{tmp_path}/out")
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect())) and sum(f.rows for f in files) == 65
    assert [("region" in c, "product_name" in c) for c in moved] == [(most == 2, False)]         # product_name has one value here
    days = sorted((f.min_day, f.max_day) for f in files)
    assert len(days) == 3 and all(a[1] <= b[0] for a, b in zip(days, days[1:]))
    for f in files:
        times = [r[0] for r in spark.read.parquet(f.path).select("timestamp").collect()]
        assert times == sorted(times)
