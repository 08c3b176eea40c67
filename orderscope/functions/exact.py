"""Exact sums of doubles of any finite size, as sums of limbs.

A double that is too large for the decimals of :mod:`~orderscope.functions.money`
is taken apart into three limbs of 24 bits over a *band*, a power of two that
divides it::

    x = (lo + mid 2^24 + hi 2^48) 2^(24 band),   0 <= lo, mid < 2^24, |hi| < 2^30

All steps are exact in doubles (scaling by a power of two, and differences
that need no more bits than they have). Limbs are summed as integers among the
rows of one band, so the result depends on no order of rows and nothing
overflows below 8 10^9 such rows in a group (beyond, Spark raises). The band is
a grouping key: rows within the ordinary range have none (null) and cost
nothing; only groups that hold huge values have more than one row after the
first aggregate, at most one for each of the 42 bands.

:func:`total` adds up the few rows of a group: carries from limb to limb, then
an exact decimal below 10^20, or the double next to the exact sum.

The smallest unit is 2^-24: doubles of 2^29 or more are exact, a smaller one
(which only an absurd discount sends here) is rounded to it. Infinity has a
band of its own and makes the sum infinite; a sum beyond the largest double is
infinite too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 24
LOWEST = -1               # the band of fractions
HIGHEST = 40              # the band of the largest double
INFINITE = 99
BASE = 1 << BITS
DECIMAL_LIMIT = 10 ** 20

WIDE = "decimal(38,0)"


def band(x: Column) -> Column:
    """The band of a finite or infinite double, one guard bit below its last bit; null stays null."""
    size = F.abs(x)
    # a rounded logarithm may be one off; the guard bit and the spare bits of ``hi`` allow for it
    exponent = F.floor(F.log2(F.greatest(size, F.lit(1.0))))
    found = F.greatest(F.floor((exponent - 53) / F.lit(float(BITS))), F.lit(LOWEST))
    return F.when(size == F.lit(float("inf")), F.lit(INFINITE)).otherwise(found).cast("smallint")


def _scaled(x: Column, at: Column) -> Column:
    """x in units of its band: a whole number below 2^78."""
    return F.rint(x * F.pow(F.lit(2.0), -(at * F.lit(BITS)).cast("double")))


def high(x: Column, at: Column) -> Column:
    """Limb 2, signed; for infinity its sign."""
    top = F.floor(_scaled(x, at) / F.lit(float(1 << 2 * BITS)))
    return F.when(at == INFINITE, F.signum(x).cast("bigint")).otherwise(top)


def _rest(x: Column, at: Column) -> Column:
    y = _scaled(x, at)
    return y - F.floor(y / F.lit(float(1 << 2 * BITS))).cast("double") * F.lit(float(1 << 2 * BITS))


def middle(x: Column, at: Column) -> Column:
    """Limb 1."""
    return F.when(at == INFINITE, F.lit(0)).otherwise(F.floor(_rest(x, at) / F.lit(float(BASE)))).cast("bigint")


def low(x: Column, at: Column) -> Column:
    """Limb 0."""
    rest = _rest(x, at)
    limb = rest - F.floor(rest / F.lit(float(BASE))).cast("double") * F.lit(float(BASE))
    return F.when(at == INFINITE, F.lit(0)).otherwise(limb.cast("bigint")).cast("bigint")


def entry(at: Column, lo: Column, mid: Column, hi: Column) -> Column:
    """The limb sums of one band as a value to collect; null without a band."""
    wide = [x.cast(WIDE) for x in (lo, mid, hi)]
    return F.when(at.isNotNull(), F.struct(at.cast("int").alias("at"), wide[0].alias("lo"), wide[1].alias("mid"), wide[2].alias("hi")))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(entries: Column, whole: Column) -> Column:
    """Base 2^24 digits of the sum from 2^-24 up, and the carry that is left: below 0 for a negative sum (digits of its complement)."""
    zero, base = F.lit(0).cast(WIDE), F.lit(BASE).cast("decimal(8,0)")
    limbs = F.flatten(F.transform(entries, lambda e: F.array(
        F.struct(e["at"].alias("at"), e["lo"].alias("v")), F.struct((e["at"] + 1).alias("at"), e["mid"].alias("v")),
        F.struct((e["at"] + 2).alias("at"), e["hi"].alias("v")))))
    limbs = F.concat(limbs, F.array(F.struct(F.lit(0).alias("at"), whole.cast(WIDE).alias("v"))))

    def step(state: Column, at: Column) -> Column:
        here = F.aggregate(limbs, state["carry"], lambda a, e: F.when(e["at"] == at, (a + e["v"]).cast(WIDE)).otherwise(a))
        return _let(here, lambda v: F.struct(((v - F.pmod(v, base)) / base).cast(WIDE).alias("carry"),
                                             F.concat(state["digits"], F.array(F.pmod(v, base).cast(WIDE))).alias("digits")))
    return F.aggregate(F.sequence(F.lit(LOWEST), F.lit(HIGHEST + 6)),
                       F.struct(zero.alias("carry"), F.array().cast(f"array<{WIDE}>").alias("digits")), step)


def _lead(number: Column) -> Column:
    """The size of a number as its highest digits (96 bits at most), how many were left, and whether those hold anything."""
    full = F.lit(str(BASE ** 3)).cast(WIDE)
    base, negative = F.lit(BASE).cast("decimal(8,0)"), number["carry"] < 0

    def step(state: Column, digit: Column) -> Column:
        own = F.when(negative, base - F.lit(1).cast("decimal(1,0)") - digit).otherwise(digit)
        return F.when(state["lead"] < full, F.struct((state["lead"] * base + own).cast(WIDE).alias("lead"), F.lit(0).alias("left"), F.lit(False).alias("more"))) \
            .otherwise(F.struct(state["lead"].alias("lead"), (state["left"] + 1).alias("left"), (state["more"] | (digit != 0)).alias("more")))
    start = F.struct(F.lit(0).cast(WIDE).alias("lead"), F.lit(0).alias("left"), F.lit(False).alias("more"))
    return F.aggregate(F.reverse(number["digits"]), start, step, lambda s: F.struct(
        # a complement is one short, which only shows if nothing below is left
        F.when(negative & ~s["more"], (s["lead"] + F.lit(1).cast("decimal(1,0)")).cast(WIDE)).otherwise(s["lead"]).alias("lead"),
        s["left"].alias("left"), s["more"].alias("more"), F.when(negative, F.lit(-1)).otherwise(F.lit(1)).alias("sign")))


def _joined(n: Column, fraction: Column) -> Column:
    """``exact`` and ``nearest`` of a number in lead form; ``fraction`` is what the ordinary sum has after the point."""
    base, unit = F.lit(BASE).cast("decimal(8,0)"), F.lit("0.000000059604644775390625").cast("decimal(24,24)")      # 2^-24
    units = F.pmod(n["lead"], base)
    size = ((n["lead"] - units) / base).cast("decimal(38,0)")
    fits = (n["left"] == 0) & (size < F.lit(str(DECIMAL_LIMIT)).cast("decimal(24,0)"))
    amount = F.when(fits, size).cast("decimal(21,0)").cast("decimal(38,17)") + (units.cast("decimal(8,0)") * unit).cast("decimal(18,17)")
    # 73 bits or more lead; what is below only decides ties
    lead = F.when(n["more"] & (units % 2 == 0), n["lead"] + F.lit(1).cast("decimal(1,0)")).otherwise(n["lead"])
    nearest = n["sign"] * lead.cast("double") * F.pow(F.lit(2.0), ((n["left"] + LOWEST) * BITS).cast("double"))
    return _let((F.when(n["sign"] < 0, -amount).otherwise(amount) + fraction).cast("decimal(38,17)"),
                lambda x: F.struct(x.alias("exact"), F.coalesce(x.cast("double"), nearest).alias("nearest")))


KIND = "struct<exact:decimal(38,17),nearest:double>"


def total(entries: Column, ordinary: Column) -> Column:
    """The exact sum of collected entries and an ordinary decimal, as ``struct<exact: decimal(38,17), nearest: double>``.

    ``exact`` is null from 10^20 on and right to 14 places after the point. ``nearest`` is the double nearest to the sum.
    """
    def of(s: Column) -> Column:
        wide, plain = s["wide"], s["plain"]
        whole = F.floor(plain).cast("decimal(22,0)")
        signs = F.transform(F.filter(wide, lambda e: e["at"] == INFINITE), lambda e: F.signum(e["hi"].cast("double")))
        infinite = F.aggregate(signs, F.lit(0.0), lambda a, x: a + x * F.lit(float("inf")))
        number = _let(_digits(wide, whole), _lead)
        return F.when(F.size(wide) == 0, F.struct(plain.alias("exact"), plain.cast("double").alias("nearest")).cast(KIND)) \
            .when(F.exists(wide, lambda e: e["at"] == INFINITE), F.struct(F.lit(None).alias("exact"), infinite.alias("nearest")).cast(KIND)) \
            .otherwise(_let(number, lambda n: _joined(n, (plain - whole).cast("decimal(18,17)"))).cast(KIND))
    return _let(F.struct(entries.alias("wide"), F.coalesce(ordinary, F.lit(0)).cast("decimal(38,17)").alias("plain")), of)
