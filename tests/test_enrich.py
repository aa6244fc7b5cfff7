"""The stream-static join with a versioned dimension."""

import pytest
from pyspark.sql import functions as F

from ordwave.operators import dims
from ordwave.operators.transform import landed_orders, orders_flagged
from ordwave.schemas import ORDERS_TOPIC
from ordwave.sources.fixtures import publish_topics
from ordwave.sources.kafka import record_files
from ordwave.streaming.enrich import EnrichedLander, VersionedDim, read_enriched
from ordwave.streaming.sinks import read_landed


def test_a_replayed_batch_joins_the_version_it_had(spark, sf_small, tmp_path):
    log = record_files(spark, f"{publish_topics(spark, sf_small)}/{ORDERS_TOPIC}")
    even, odd = log.where("offset % 2 = 0"), log.where("offset % 2 = 1")
    dim = VersionedDim(str(tmp_path / "dim"))
    root = str(tmp_path / "landed")
    lander = EnrichedLander("orders", root, orders_flagged, landed_orders, "orders", dim=dim)
    with pytest.raises(ValueError, match="no version"):
        lander(even, 0)
    products = dims.product_dim(spark, sf_small)
    assert dim.publish(products) == 0
    lander(even, 0)
    first = sorted(map(tuple, read_enriched(spark, root, "orders").collect()), key=str)
    assert first and {r[-1] for r in first} == {0}
    assert dim.publish(products.withColumn("base_price", F.col("base_price") * 2)) == 1
    lander(even, 0)                                         # replayed after the change
    assert sorted(map(tuple, read_enriched(spark, root, "orders").collect()), key=str) == first
    lander(odd, 1)
    got = read_enriched(spark, root, "orders")
    assert {r.dim_version: r.n for r in got.groupBy("dim_version").agg(F.count(F.lit(1)).alias("n")).collect()}[0] == len(first)
    price = {r.product_id: r.base_price for r in products.collect()}
    for r in got.select("product_id", "dim_base_price", "dim_version").collect():
        want = price.get(r.product_id)
        assert r.dim_base_price == (want if want is None else want * (1 + r.dim_version))
    assert got.drop("dim_base_price", "dim_version").exceptAll(read_landed(spark, root, "orders").select(got.columns[:-2])).count() == 0
    assert got.count() == read_landed(spark, root, "orders").count()
