"""Decode, parse and convert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import ORDERS, PRICING

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def decode_value(value="value") -> Column:
    """Kafka ``value`` bytes -> UTF-8 text."""
    return _c(value).cast("string")


def parse_event_time(text) -> Column:
    """ISO text -> TIMESTAMP; malformed text -> NULL instead of an
    ANSI error (R8). Text without an offset is read in the session zone,
    which ``ensure_session_defaults`` pins to UTC (R5)."""
    return F.try_to_timestamp(_c(text))


def to_ntz(ts) -> Column:
    """Wall-clock (UTC) timestamp without zone, the form landed tables use."""
    return _c(ts).cast("timestamp_ntz")


def event_date(ts) -> Column:
    """Timestamp -> calendar date."""
    return F.to_date(_c(ts))


def to_iso_text(ts) -> Column:
    """Timestamp -> ISO text with all six fraction digits (``to_json``
    alone would cut timestamps to milliseconds)."""
    return F.date_format(_c(ts), ISO_MICROS)


def parse_json(records: DataFrame, schema: StructType, keep_raw: bool = True) -> DataFrame:
    """Kafka-shaped records -> one typed column per schema field,
    permissive (a malformed message gives NULL fields, never a failure),
    plus the record's coordinates for lineage and quarantine."""
    cols = [F.from_json(decode_value("value"), schema).alias("data"),
            F.col("topic"), F.col("partition"), F.col("offset"),
            F.col("timestamp").alias("kafka_timestamp")]
    if keep_raw:
        cols += [F.col("value").alias("value_raw"), F.col("key").alias("key_raw")]
    rest = ["topic", "partition", "offset", "kafka_timestamp"] + (["value_raw", "key_raw"] if keep_raw else [])
    # ``inline`` of a one-element array flattens the struct like ``data.*``
    # but is a Generate node: filters on the parsed fields stay above it, so
    # the JSON is parsed once per record instead of once per tested field
    # (a pushed-down filter would re-run from_json with pruned schemas).
    return records.select(*cols).select(F.inline(F.array(F.col("data"))), *rest)


def _parse_typed(records: DataFrame, schema: StructType) -> DataFrame:
    parsed = parse_json(records, schema)
    return (parsed
            .withColumnRenamed("timestamp", "timestamp_text")
            .withColumn("timestamp", parse_event_time("timestamp_text")))


def parse_orders(records: DataFrame) -> DataFrame:
    """Orders topic records -> typed order rows (timestamp parsed);
    ``timestamp_text``, ``value_raw`` and ``key_raw`` kept for validation/quarantine."""
    return _parse_typed(records, ORDERS)


def parse_pricing(records: DataFrame) -> DataFrame:
    return _parse_typed(records, PRICING)


def to_json_value(fields, ignore_nulls: bool = False) -> Column:
    """P10: columns -> JSON bytes. NULL fields are written as ``null``
    (as a JSON encoder of a dict does) unless ``ignore_nulls``."""
    cols = [_c(f) for f in fields]
    opts = {"ignoreNullFields": "true" if ignore_nulls else "false"}
    return F.to_json(F.struct(*cols), opts).cast("binary")


def coerce_booleans(flagged: DataFrame, names=("is_returned", "in_stock")) -> DataFrame:
    """Booleans that the typed schema could not read (text, numbers) are
    taken from the record itself and cast: "true", "yes", 1, "0", ... Only where
    the column exists; only records whose field is NULL are looked at again. A
    value that is no boolean makes the row bad (``<name>_not_boolean``)."""
    for n in names:
        if n in flagged.columns:
            json = F.try_parse_json(decode_value("value_raw"))
            text = F.when(F.col(n).isNull(), F.try_variant_get(json, f"$.{n}", "string"))
            made = flagged.withColumn("_text", text).withColumn("_bool", F.coalesce(F.col(n), F.trim("_text").try_cast("boolean")))
            wrong = F.col("_bool").isNull() & F.col("_text").isNotNull()
            flagged = (made.withColumn(n, F.col("_bool"))
                       .withColumn("quality_reasons", F.when(wrong, F.array_append("quality_reasons", F.lit(f"{n}_not_boolean"))).otherwise(F.col("quality_reasons")))
                       .withColumn("has_quality_issues", F.col("has_quality_issues") | wrong).drop("_text", "_bool"))
    return flagged
