"""Text formats of the question answers and dashboard tables, as Spark columns.

``format_number`` rounds half-even on the binary value, like Python's
``format`` does, so these columns equal the Python f-strings
``{:,.0f}``, ``{:,.2f}``, ``{:.2f}``, ``{:.1f}`` and ``{:+.1f}``.
``format_string('%.2f')`` would round half-up instead and is not used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spanish month abbreviations, January first.
MONTH_NAMES = ["Ene", "Feb", "Mar", "Abr", "May", "Jun",
               "Jul", "Ago", "Sep", "Oct", "Nov", "Dic"]


def thousands(x: Column) -> Column:
    """``f"{x:,.0f}"`` / ``f"{int(x):,}"``."""
    return F.format_number(x.cast("double"), 0)


def money0(x: Column) -> Column:
    """``f"${x:,.0f}"``."""
    return F.concat(F.lit("$"), thousands(x))


def money2(x: Column) -> Column:
    """``f"${x:,.2f}"``."""
    return F.concat(F.lit("$"), F.format_number(x.cast("double"), 2))


def fixed(x: Column, decimals: int) -> Column:
    """``f"{x:.Nf}"``: fixed decimals, no thousands separator."""
    pattern = "0" if decimals == 0 else "0." + "0" * decimals
    return pattern_format(x, pattern)


def pattern_format(x: Column, pattern: str) -> Column:
    """``format_number`` with a decimal-format pattern (no grouping unless asked)."""
    return F.call_function("format_number", x.cast("double"), F.lit(pattern))


def signed_pct(x: Column) -> Column:
    """``f"{x:+.1f}%"``; null stays null."""
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.concat(sign, fixed(F.abs(x), 1), F.lit("%"))


def month_name(month: Column) -> Column:
    """Abbreviated Spanish month name of a month number 1..12."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), month.cast("int"))


def period(year: Column, month: Column) -> Column:
    """``YYYY-MM`` label of a year and month."""
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))
