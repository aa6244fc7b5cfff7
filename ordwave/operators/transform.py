"""The shared record -> table transforms (same function for batch and
stream), and the output shapes of landed and quarantined rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.business import undercut_flag
from ..functions.parse import event_date, parse_orders, parse_pricing, to_ntz
from ..schemas import ORDER_FIELDS, PRICING_FIELDS
from .validate import flag_quality

LANDED_ORDER_COLUMNS = ORDER_FIELDS + ["event_date"]
LANDED_PRICING_COLUMNS = PRICING_FIELDS + ["is_undercut", "event_date"]


def orders_flagged(records: DataFrame, validator: str = "nulls") -> DataFrame:
    """Parse, convert and flag order records."""
    return flag_quality(parse_orders(records), validator)


def pricing_flagged(records: DataFrame, validator: str | None = None) -> DataFrame:
    """Parse, convert, derive ``is_undercut``; pricing is not
    validated unless asked (R9)."""
    p = parse_pricing(records).withColumn("is_undercut", undercut_flag("price_diff"))
    if validator:
        return flag_quality(p, validator)
    return p.withColumn("quality_reasons", F.array().cast("array<string>")) \
            .withColumn("has_quality_issues", F.lit(False))


def landed_orders(flagged: DataFrame, extra=()) -> DataFrame:
    """Good rows in the landed-table shape: the 18 event fields with the
    timestamp as wall-clock UTC (TIMESTAMP_NTZ), plus ``event_date``."""
    cols = [to_ntz("timestamp").alias("timestamp") if f == "timestamp" else F.col(f) for f in ORDER_FIELDS]
    return flagged.select(*cols, event_date("timestamp").alias("event_date"), *extra)


def landed_pricing(flagged: DataFrame, extra=()) -> DataFrame:
    cols = [to_ntz("timestamp").alias("timestamp") if f == "timestamp" else F.col(f) for f in PRICING_FIELDS]
    return flagged.select(*cols, "is_undercut", event_date("timestamp").alias("event_date"), *extra)


LANDED_COLUMNS = {"orders": LANDED_ORDER_COLUMNS, "pricing_events": LANDED_PRICING_COLUMNS}
QUARANTINE_COLUMNS = ["key", "value", "topic", "partition", "offset", "kafka_timestamp", "quality_reasons"]


def landing_rows(flagged: DataFrame, shape) -> DataFrame:
    """One output row per input record: the landed columns, the record's
    Kafka coordinates (lineage), ``status`` good/bad, and for bad rows only
    the raw key and value (bytes, so that the record can be sent again) and the
    failed rules. Written once, partitioned by
    ``status``: the good partition is the landed table, the bad partition is
    the quarantine (K3)."""
    bad = F.col("has_quality_issues")
    extra = [F.when(bad, F.col("key_raw")).alias("key"), F.when(bad, F.col("value_raw")).alias("value"), "topic", "partition", "offset",
             "kafka_timestamp", F.when(bad, F.col("quality_reasons")).alias("quality_reasons"),
             F.when(bad, "bad").otherwise("good").alias("status")]
    return shape(flagged, extra)
