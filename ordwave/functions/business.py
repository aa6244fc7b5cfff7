"""Derived business columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rounding import r2

# ---- fixed values that define the event contract -------------------------
BUDGET_BELOW = 5000.0      # base price < 5000  -> budget
MID_BELOW = 25000.0        # base price < 25000 -> mid, else premium
OWN_BAND = (0.90, 1.06)    # own final price within base x [0.90, 1.06]
ORDER_ID_PATTERN = "^ORD-[A-Z]{2}[0-9]{4}[A-Z]{2}[0-9]{4}$"
# tolerance for audits of values that were rounded to cents upstream
CENT_TOLERANCE = 0.01 + 1e-9
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def price_tier(base_price="base_price") -> Column:
    """Half-open tiers; NULL stays NULL."""
    b = _c(base_price)
    return (F.when(b < BUDGET_BELOW, "budget")
            .when(b < MID_BELOW, "mid")
            .when(b.isNotNull(), "premium"))


def order_value(final_price="final_price", quantity="quantity") -> Column:
    """total = final price x quantity, in cents; the discount is not
    applied (R13)."""
    return r2(_c(final_price) * _c(quantity))


def price_diff(our_price="our_price", competitor_price="competitor_price") -> Column:
    """D3: our price minus the competitor's, in cents."""
    return r2(_c(our_price) - _c(competitor_price))


def price_diff_pct(diff="price_diff", our_price="our_price") -> Column:
    """Percent of our price, of the rounded difference; NULL on a zero
    price (R11)."""
    return r2(F.try_divide(_c(diff), _c(our_price)) * 100)


def undercut_flag(diff="price_diff") -> Column:
    """``price_diff < 0`` (we are cheaper, R6); NULL/absent -> false."""
    return F.coalesce(_c(diff) < 0, F.lit(False))


def price_position(diff="price_diff") -> Column:
    """competitor's view: 'cheaper' when our price is higher, a tie is
    'pricier'."""
    d = _c(diff)
    return F.when(d > 0, "cheaper").when(d.isNotNull(), "pricier")


def own_price_band(final_price="final_price", base_price="base_price") -> Column:
    """Final price inside base x [0.90, 1.06], with a cent of slack for
    the upstream rounding."""
    f, b = _c(final_price), _c(base_price)
    return f.between(b * OWN_BAND[0] - CENT_TOLERANCE, b * OWN_BAND[1] + CENT_TOLERANCE)


def is_weekend_spike(ts, category, categories) -> Column:
    """Saturday or Sunday (weekday: Monday=0) and a spike category."""
    return (F.weekday(_c(ts)) >= 5) & _c(category).isin(list(categories))


def order_id_format_ok(order_id="order_id") -> Column:
    """``ORD-`` + two letters, four digits, two letters, four digits."""
    return F.coalesce(_c(order_id).rlike(ORDER_ID_PATTERN), F.lit(False))


def fixed_width(text, width: int, align: str = "left") -> Column:
    """Text cut to ``width`` and padded (only for bounded text)."""
    t = F.coalesce(_c(text).cast("string"), F.lit(""))
    return F.rpad(t, width, " ") if align == "left" else F.lpad(t, width, " ")
