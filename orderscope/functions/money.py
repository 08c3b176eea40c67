"""Exact money arithmetic.

Order-line revenue has more decimals than cents, so double sums land on
half-cents and depend on the order of rows. Revenue is therefore summed
exactly, in three ways that add up:

* rows whose price and discount have at most two decimals (and whose revenue
  is below 10^10) are whole **millionths**:
  ``cents(price) x qty x (10000 - hundredths(discount %))``, a ``long``, summed
  as whole units and remainder. That stays in primitive arithmetic;
* other rows below 10^12 are decimals: the price to nine decimals, the discount
  share to eight. They cost a ``BigDecimal`` each, but only they do;
* all others (any finite price, and discounts of 10^4 % or more) are the doubles
  that the clean table shows, summed as limbs (:mod:`~orderscope.functions.exact`).

Per-group totals are combined into one exact sum, rounded half-up to cents and
exposed as a double. No price aborts a report.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICRO = 1_000_000
MICRO_LIMIT = 1e10
DECIMAL_LIMIT = 1e12
DISCOUNT_LIMIT = 1e4


def revenue_double(price: Column, qty: Column, discount_pct: Column) -> Column:
    """Row-level revenue as the reference shows it: price x qty x (1 - d/100)."""
    return price * qty * (F.lit(1) - discount_pct / F.lit(100))


def _hundredths(x: Column) -> Column:
    """x in hundredths, rounded; exact where :func:`two_decimals` holds."""
    return F.rint(x * F.lit(100.0)).cast("bigint")


def two_decimals(x: Column) -> Column:
    """Whether a double is the one nearest to a number with at most two decimals."""
    return F.rint(x * F.lit(100.0)) / F.lit(100.0) == x


def is_micro(price: Column, qty: Column, discount_pct: Column) -> Column:
    """Whether a row's revenue is a whole number of millionths that fits a long."""
    small = (F.abs(price) * F.abs(qty.cast("double")) * (F.abs(discount_pct) + 100.0)) < F.lit(MICRO_LIMIT * 100)
    return small & two_decimals(price) & two_decimals(discount_pct)


def revenue_micro(price: Column, qty: Column, discount_pct: Column) -> Column:
    """Row revenue in millionths as a long, where :func:`is_micro` holds."""
    factor = F.lit(10000).cast("bigint") - _hundredths(discount_pct)
    return _hundredths(price) * qty.cast("bigint") * factor


def is_decimal(price: Column, qty: Column, discount_pct: Column) -> Column:
    """Whether a row's revenue fits the decimal sums (with room for 10^9 such rows in a group)."""
    amount = F.abs(price) * F.abs(qty.cast("double"))
    return (amount * (F.abs(discount_pct) + 100.0) < F.lit(DECIMAL_LIMIT * 100)) & (F.abs(discount_pct) < F.lit(DISCOUNT_LIMIT))


def revenue_decimal(price: Column, qty: Column, discount_pct: Column) -> Column:
    """Row revenue as a decimal, for rows that are no whole millionths."""
    amount = (price.cast("decimal(24,9)") * qty.cast("decimal(10,0)")).cast("decimal(24,9)")
    share = (F.lit(1).cast("decimal(9,0)") - discount_pct.cast("decimal(11,6)") * F.lit("0.01").cast("decimal(3,2)"))
    return (amount * share.cast("decimal(13,8)")).cast("decimal(38,17)")


def remainder_part(micro: Column) -> Column:
    """micro mod 10^6, in [0, 10^6)."""
    return F.pmod(micro, F.lit(MICRO).cast("bigint"))


def whole_part(micro: Column) -> Column:
    """floor(micro / 10^6), in integer arithmetic."""
    return F.call_function("div", micro - remainder_part(micro), F.lit(MICRO).cast("bigint"))


def combine(whole_sum: Column, remainder_sum: Column, decimal_sum: Column) -> Column:
    """Exact total from the summed parts; null if there was no row of either kind."""
    zero = F.lit(0)
    whole = F.coalesce(whole_sum, zero).cast("decimal(21,0)")
    frac = (F.coalesce(remainder_sum, zero).cast("decimal(20,0)") / F.lit(MICRO)).cast("decimal(27,6)")
    total = whole.cast("decimal(27,6)") + frac + F.coalesce(decimal_sum, zero).cast("decimal(38,17)")
    return F.when(whole_sum.isNotNull() | remainder_sum.isNotNull() | decimal_sum.isNotNull(), total)


def round_money(total: Column) -> Column:
    """Round an exact decimal amount to cents and expose it as a double."""
    return F.round(total, 2).cast("double")


def sum_money(value: Column) -> Column:
    """Aggregate: sum of amounts in cents given as doubles; exact unless one is 10^17 or more."""
    large = F.abs(value) >= 1e17
    cents = F.sum(F.when(~large, value).cast("decimal(20,2)"))
    return F.when(F.count_if(large) > 0, F.sum(value)).otherwise(F.round(cents, 2).cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator in double, null instead of an error on zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
