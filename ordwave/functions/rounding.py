"""Rounding to cents.

``floor(x*100 + 0.5) / 100`` is the same sequence of IEEE operations in
Spark and in any SQL engine, so values computed here compare exactly
with an oracle (Spark's ``round`` is HALF_UP on the decimal expansion and
differs from other engines on ties such as 2.675).

``floor`` of a double is a BIGINT, which has no NaN or infinity: values
without exact cents (NaN, infinities, and beyond 2^53 cents) stay as they are.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT_CENTS = float(1 << 53)


def _has_cents(x: Column) -> Column:
    return F.abs(x * 100) < EXACT_CENTS      # false for NaN, which sorts above every number


def r2(x) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    x = x.cast("double")
    return F.when(_has_cents(x), F.floor(x * 100 + 0.5) / 100).otherwise(x)


def cents(x) -> Column:
    """Exact integer cents of a value already rounded to cents; sums of
    cents are exact and independent of the summation order. NULL where the
    value has no exact cents."""
    x = F.col(x) if isinstance(x, str) else x
    x = x.cast("double")
    return F.when(_has_cents(x), F.floor(x * 100 + 0.5).cast("bigint"))
