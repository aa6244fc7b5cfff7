"""Record validation.

Validation never drops a row by itself: it adds ``quality_reasons`` (the
names of the failed rules) and the boolean ``has_quality_issues``; the
sink routes rows to the landed table or to quarantine, so good + bad =
input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import PRICING_FIELDS


def _reasons(rules) -> Column:
    return F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]),
                    lambda x: x.isNotNull())


def _truthy_text(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def nulls_rules():
    """Default validator: NULL order id, product id or (parsed) timestamp."""
    return [("order_id_null", F.col("order_id").isNull()),
            ("product_id_null", F.col("product_id").isNull()),
            ("timestamp_null", F.col("timestamp").isNull())]


def strict_rules():
    """Strict validator: six fields must be truthy ('' and 0 fail, NaN
    passes); the timestamp text must also parse (R8)."""
    rules = [(f"{f}_falsy", ~_truthy_text(F.col(f)))
             for f in ("order_id", "product_id", "category")]
    fp = F.col("final_price")
    rules.append(("final_price_falsy", fp.isNull() | (fp == 0)))
    rules.append(("region_falsy", ~_truthy_text(F.col("region"))))
    rules.append(("timestamp_falsy", ~_truthy_text(F.col("timestamp_text"))))
    rules.append(("timestamp_unparseable", _truthy_text(F.col("timestamp_text")) & F.col("timestamp").isNull()))
    return rules


def pricing_rules():
    """Optional pricing quarantine: unparseable record or no timestamp."""
    all_null = F.lit(True)
    for f in PRICING_FIELDS:
        all_null = all_null & F.col(f if f != "timestamp" else "timestamp_text").isNull()
    return [("unparseable", all_null), ("timestamp_null", F.col("timestamp").isNull())]


RULESETS = {"nulls": nulls_rules, "strict": strict_rules, "pricing": pricing_rules}


def flag_quality(parsed: DataFrame, validator: str = "nulls") -> DataFrame:
    """``has_quality_issues`` is a plain OR of the rules (it stays inside
    whole-stage codegen); the reasons array is only materialised where a
    quarantine write selects it."""
    rules = RULESETS[validator]()
    any_bad = F.lit(False)
    for _, cond in rules:
        any_bad = any_bad | F.coalesce(cond, F.lit(False))
    return (parsed.withColumn("quality_reasons", _reasons(rules))
            .withColumn("has_quality_issues", any_bad))


def good_rows(flagged: DataFrame) -> DataFrame:
    """F1"""
    return flagged.where(~F.col("has_quality_issues"))


def bad_rows(flagged: DataFrame) -> DataFrame:
    """F2"""
    return flagged.where(F.col("has_quality_issues"))
