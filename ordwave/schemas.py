"""Fixed schemas. Field order is the contract with the producers."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _strings(*names):
    return [StructField(n, StringType()) for n in names]


def _doubles(*names):
    return [StructField(n, DoubleType()) for n in names]


ORDERS = StructType(
    _strings("event_type", "order_id", "product_id", "product_name", "category", "brand", "price_tier")
    + _doubles("base_price", "final_price", "discount_percent")
    + [StructField("quantity", IntegerType())]
    + _doubles("total_value")
    + _strings("region", "city", "payment_method", "customer_segment")
    + [StructField("is_returned", BooleanType()), StructField("timestamp", StringType())]
)

PRICING = StructType(
    _strings("event_type", "product_id", "product_name", "category", "brand", "competitor")
    + _doubles("competitor_price", "our_price", "price_diff", "price_diff_pct")
    + [StructField("in_stock", BooleanType()), StructField("timestamp", StringType())]
)

# What a Kafka source yields (the fixed schema of Spark's Kafka connector).
KAFKA_RECORD = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)

# the quarantine as read back (``streaming.sinks.read_quarantine``)
QUARANTINE = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("kafka_timestamp", TimestampType()),
        StructField("quality_reasons", ArrayType(StringType())),
        StructField("batch", StringType()),
    ]
)

# one row per attempt at a micro-batch (``audit/query=/batch_id=/attempt=``)
BATCH_AUDIT = StructType(
    [
        StructField("query", StringType()),
        StructField("batch_id", LongType()),
        StructField("n_in", LongType()),
        StructField("n_good", LongType()),
        StructField("n_bad", LongType()),
        StructField("status", StringType()),
        StructField("error", StringType()),
        StructField("sample", StringType()),
        StructField("at", TimestampNTZType()),
        StructField("attempt", LongType()),
    ]
)

ORDER_FIELDS = [f.name for f in ORDERS.fields]
PRICING_FIELDS = [f.name for f in PRICING.fields]

ORDERS_TOPIC = "orders-topic"
PRICING_TOPIC = "pricing-topic"


# the audit as files: the batch coordinates are partition columns
AUDIT_FILES = "n_in bigint, n_good bigint, n_bad bigint, status string, error string, sample string, at timestamp_ntz, query string, batch_id bigint, attempt bigint"


def landing_schema(table: str) -> str:
    """Columns of a table's batch files (good and bad rows share them), with
    the partition columns last."""
    event, derived = {"orders": (ORDERS, ""), "pricing_events": (PRICING, "is_undercut boolean, ")}[table]
    cols = ", ".join(f"{f.name} {'timestamp_ntz' if f.name == 'timestamp' else f.dataType.simpleString()}" for f in event.fields)
    return (f"{cols}, {derived}event_date date, key binary, value binary, topic string, partition int, offset bigint, "
            "kafka_timestamp timestamp, quality_reasons array<string>, batch string, status string")
