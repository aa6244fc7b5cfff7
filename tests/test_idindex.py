"""First arrivals by the key index: replays any time later, merges, crashes."""

import random

import pytest
from pyspark.sql import functions as F

from ordwave.schemas import ORDERS_TOPIC
from ordwave.sources.fixtures import publish_topics
from ordwave.sources.kafka import record_files
from ordwave.streaming import idindex
from ordwave.streaming.sinks import read_landed, read_unique
from ordwave.streaming.streams import unique_orders_lander


def frame(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "key string").coalesce(2)


def land(spark, index, keys, batch):
    """What a lander does with the distinct keys of a batch; returns the new ones."""
    df = frame(spark, sorted(set(keys)))
    seen = index.seen(df, batch)
    new = df if seen is None else df.join(seen, "key", "left_anti")
    new = [r.key for r in new.collect()]
    index.add(frame(spark, new), batch)
    index.merge(spark, batch)
    return new


@pytest.mark.parametrize("blocks", [1 << 14, 1])
def test_any_replay_is_found(spark, tmp_path, monkeypatch, blocks):
    """Keys come again one or many batches later; with a single bitmap, most
    new keys pass it and only the index tells."""
    monkeypatch.setattr(idindex, "TIER", 3)
    monkeypatch.setattr(idindex, "BLOCKS", blocks)
    index = idindex.IdIndex(str(tmp_path))
    r, known = random.Random(blocks), set()
    for batch in range(14):
        size = 400 if blocks == 1 else 20
        keys = [f"o{batch}-{i}" for i in range(size)] + r.sample(sorted(known), min(len(known), 5)) + (["o0-3"] if batch == 13 else [])
        new = land(spark, index, keys, batch)
        assert set(new) == set(keys) - known and len(new) == len(set(new))
        known |= set(keys)
    ranges = index.widest(index.ranges(spark))
    assert len(ranges) <= 5 and ranges[0][0] == 0 and ranges[-1][1] == 13
    got = index._read(spark, "keys", ranges)
    assert sorted(x.key for x in got.collect()) == sorted(known)                # each key once


def test_a_replayed_batch_does_not_see_itself(spark, tmp_path):
    index = idindex.IdIndex(str(tmp_path))
    assert sorted(land(spark, index, ["a", "b"], 0)) == ["a", "b"]
    assert sorted(land(spark, index, ["b", "c"], 1)) == ["c"]
    assert sorted(land(spark, index, ["b", "c"], 1)) == ["c"]
    assert land(spark, index, ["a", "b", "c"], 2) == []


def test_an_index_without_its_bitmaps_is_not_read(spark, tmp_path):
    """A crash between the two writes: the batch is replayed and completes both."""
    index = idindex.IdIndex(str(tmp_path))
    land(spark, index, ["a"], 0)
    idindex.delete(spark, index._path("blooms", 0, 0))
    assert index.ranges(spark) == []
    assert land(spark, index, ["a"], 0) == ["a"]


def test_unique_orders_in_many_batches(spark, sf_small, tmp_path):
    """Rows of each order arrive in several micro-batches, early ones again at
    the end: the table holds the first of each, as the batch form does."""
    log = record_files(spark, f"{publish_topics(spark, sf_small)}/{ORDERS_TOPIC}")
    lander = unique_orders_lander(str(tmp_path))
    slices = [log.where(F.col("offset") % 5 == i) for i in range(5)]
    for batch, part in enumerate([*slices, slices[0], slices[3]]):
        lander(part, batch)
    lander(slices[3], 6)                                    # the last batch once more
    unique, every = read_unique(spark, str(tmp_path), "orders"), read_landed(spark, str(tmp_path), "orders")
    blank = F.trim(F.col("order_id")) == ""
    ids = unique.where(~blank).select("order_id")
    assert ids.count() == ids.distinct().count() == every.where(~blank).select("order_id").distinct().count()
    assert unique.where(blank).count() == every.where(blank).distinct().count() > 1
    assert unique.exceptAll(every).count() == 0
    assert every.count() > unique.count()


def test_rows_of_one_id_that_come_together_are_chosen_as_in_the_batch_form(spark, tmp_path):
    names = "event_type, order_id, product_id, quantity, timestamp"
    value = F.to_json(F.expr(f"named_struct({', '.join(repr(n) + ', ' + n for n in names.split(', '))})")).cast("binary")
    rows = spark.sql("SELECT 'order_placed' AS event_type, 'A' AS order_id, 'P' AS product_id, CAST(5 - id AS INT) AS quantity, "
                     "'1997-05-11T14:26:12' AS timestamp, id AS offset FROM range(3)")
    log = rows.select(F.lit(None).cast("binary").alias("key"), value.alias("value"), F.lit(ORDERS_TOPIC).alias("topic"),
                      F.lit(0).alias("partition"), "offset", F.current_timestamp().alias("timestamp"), F.lit(1).alias("timestampType"))
    unique_orders_lander(str(tmp_path))(log, 0)
    assert [r.quantity for r in read_unique(spark, str(tmp_path), "orders").collect()] == [3]
