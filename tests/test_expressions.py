"""Expression-level cases: JSON parse outcomes, validators, business rules."""

import math

import pytest
from pyspark.sql import functions as F

from ordwave.functions.business import (
    order_id_format_ok,
    price_position,
    price_tier,
    undercut_flag,
)
from ordwave.functions.parse import parse_event_time, parse_json
from ordwave.functions.rounding import r2
from ordwave.operators.validate import flag_quality
from ordwave.schemas import KAFKA_RECORD, ORDERS


def _records(spark, values):
    rows = [(None, None if v is None else v.encode(), "orders-topic", 0, i, None, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, KAFKA_RECORD)


def _parse(spark, values, schema=ORDERS):
    return parse_json(_records(spark, values), schema).orderBy("offset").collect()


def test_malformed_json_gives_all_null_fields(spark):
    rows = _parse(spark, ['{"order_id": "A", "quan', '"just a string"', '[1, 2]', "", None])
    for r in rows:
        assert all(r[f.name] is None for f in ORDERS.fields)


def test_wrong_type_field_is_null_others_kept(spark):
    rows = _parse(spark, ['{"order_id": "A", "quantity": "x"}', '{"order_id": "B", "quantity": 2.0}',
                          '{"order_id": "C", "is_returned": "true"}', '{"order_id": "D", "final_price": "18999"}'])
    assert [r.order_id for r in rows] == ["A", "B", "C", "D"]
    assert rows[0].quantity is None and rows[1].quantity is None
    assert rows[2].is_returned is None and rows[3].final_price is None


def test_string_field_takes_numbers_and_objects_as_text(spark):
    rows = _parse(spark, ['{"order_id": 123}', '{"order_id": {"a":1}}'])
    assert rows[0].order_id == "123"
    assert rows[1].order_id.replace(" ", "") == '{"a":1}'


def test_duplicate_key_case_and_extra_keys(spark):
    rows = _parse(spark, ['{"order_id": "A", "order_id": "B"}', '{"ORDER_ID": "A"}', '{"order_id": "A", "zzz": 1}'])
    assert rows[0].order_id == "B"
    assert rows[1].order_id is None
    assert rows[2].order_id == "A"


def test_nan_and_integer_for_double(spark):
    rows = _parse(spark, ['{"final_price": NaN}', '{"final_price": 12}'])
    assert math.isnan(rows[0].final_price)
    assert rows[1].final_price == 12.0


@pytest.mark.parametrize("text,expected", [
    ("2024-01-02T03:04:05.123456", "2024-01-02 03:04:05.123456"),
    ("2024-01-02T03:04:05", "2024-01-02 03:04:05"),
    ("2024-01-02T08:34:05+05:30", "2024-01-02 03:04:05"),
    ("2024-01-02", "2024-01-02 00:00:00"),
    ("", None), ("not-a-time", None), ("1704164645", None),
])
def test_timestamp_parse(spark, text, expected):
    v = spark.range(1).select(parse_event_time(F.lit(text)).cast("timestamp_ntz").cast("string").alias("t")).first().t
    if expected is None:
        assert v is None
    else:
        assert v.startswith(expected)


def _flag(spark, json_values, validator):
    recs = _records(spark, json_values)
    from ordwave.operators.transform import orders_flagged
    return orders_flagged(recs, validator).orderBy("offset").collect()


GOOD = '{"order_id":"%s","product_id":"P","category":"C","final_price":%s,"region":"R","timestamp":"%s"}'


def test_validators_nulls_vs_strict(spark):
    vals = [GOOD % ("A", "1.0", "2024-01-01T00:00:00"),
            GOOD % ("", "1.0", "2024-01-01T00:00:00"),
            GOOD % ("A", "0", "2024-01-01T00:00:00"),
            GOOD % ("A", "0.0", "2024-01-01T00:00:00"),
            GOOD % ("A", "NaN", "2024-01-01T00:00:00"),
            GOOD % ("A", "1.0", "not-a-time")]
    nulls = [r.has_quality_issues for r in _flag(spark, vals, "nulls")]
    strict = [r.has_quality_issues for r in _flag(spark, vals, "strict")]
    assert nulls == [False, False, False, False, False, True]
    assert strict == [False, True, True, True, False, True]
    reasons = _flag(spark, [None], "nulls")[0].quality_reasons
    assert sorted(reasons) == ["order_id_null", "product_id_null", "timestamp_null"]


@pytest.mark.parametrize("base,tier", [(4999.99, "budget"), (5000.0, "mid"), (24999.99, "mid"),
                                       (25000.0, "premium"), (None, None)])
def test_price_tier_boundaries(spark, base, tier):
    assert spark.range(1).select(price_tier(F.lit(base).cast("double")).alias("t")).first().t == tier


@pytest.mark.parametrize("diff,undercut,position", [(-0.01, True, "pricier"), (0.0, False, "pricier"),
                                                    (0.01, False, "cheaper"), (None, False, None)])
def test_undercut_and_position(spark, diff, undercut, position):
    r = spark.range(1).select(undercut_flag(F.lit(diff).cast("double")).alias("u"),
                              price_position(F.lit(diff).cast("double")).alias("p")).first()
    assert r.u is undercut and r.p == position


def test_undercut_absent_field(spark):
    from ordwave.operators.transform import pricing_flagged
    recs = _records(spark, ['{"product_id":"P"}', None])
    assert [r.is_undercut for r in pricing_flagged(recs).collect()] == [False, False]


@pytest.mark.parametrize("x,expected", [(2.675, 2.68), (1.005, 1.0), (-0.0, 0.0), (1234.565, 1234.57)])
def test_round_to_cents(spark, x, expected):
    assert spark.range(1).select(r2(F.lit(x)).alias("v")).first().v == expected


@pytest.mark.parametrize("oid,ok", [("ORD-AB1234CD5678", True), ("ORD-ab1234CD5678", False),
                                    ("ORD-AB1234CD567", False), ("", False), (None, False)])
def test_order_id_format(spark, oid, ok):
    assert spark.range(1).select(order_id_format_ok(F.lit(oid).cast("string")).alias("v")).first().v is ok


def test_rounding_keeps_values_without_cents(spark):
    from ordwave.functions.business import order_value, price_diff, price_diff_pct
    from ordwave.functions.rounding import cents, r2
    nan, inf = float("nan"), float("inf")
    rows = [(2.675, 1), (nan, 2), (inf, 3), (-inf, 4), (1e18, 5), (None, 6), (-2.345, 7)]
    df = spark.createDataFrame(rows, "x double, i int")
    got = {r.i: (r.a, r.b) for r in df.select("i", r2("x").alias("a"), cents("x").alias("b")).collect()}
    assert got[1] == (2.68, 268) and got[7] == (-2.35, -235) and got[6] == (None, None)
    assert got[2][0] != got[2][0] and got[2][1] is None
    assert got[3] == (inf, None) and got[4] == (-inf, None) and got[5] == (1e18, None)
    r = spark.createDataFrame([(nan, 10.0)], "a double, b double").select(
        price_diff("b", "a").alias("d"), order_value("a", "b").alias("v"), price_diff_pct("a", "b").alias("p")).first()
    assert all(x != x for x in r)                      # unknown stays unknown
