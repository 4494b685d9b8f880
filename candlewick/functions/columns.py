"""Column-level predicates and scalar helpers.

All are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(name_or_col) -> Column:
    return F.col(name_or_col) if isinstance(name_or_col, str) else name_or_col


def rel_change(new, old) -> Column:
    """(new - old) / old, NULL when old is 0 or NULL (ANSI-safe)."""
    return F.try_divide(c(new) - c(old), c(old))


def above_mas(windows, strict: bool = False, close: str = "close", prefix: str = "ma") -> Column:
    """Close at (>=) or strictly above (>) each moving average."""
    preds = [(F.col(close) > F.col(f"{prefix}{n}")) if strict else (F.col(close) >= F.col(f"{prefix}{n}"))
             for n in windows]
    return reduce(lambda a, b: a & b, preds)


def short_upper_shadow(limit: float, base: str = "close") -> Column:
    """P10: (high - close) / base <= limit (base = close or open)."""
    return F.try_divide(F.col("high") - F.col("close"), F.col(base)) <= F.lit(limit)


def bullish_touch_prev_close() -> Column:
    """Close > open and the low reached yesterday's close."""
    return (F.col("close") > F.col("open")) & (F.col("low") <= F.col("close") - F.col("price_change"))


def not_suspended(col: str = "open") -> Column:
    """A traded bar has a positive open (or positive min close)."""
    return F.col(col) > 0


def not_risk_flagged(col: str = "name") -> Column:
    """Name does not contain `ST`."""
    return ~F.col(col).like("%ST%")


def p_change_between(lo: float, hi: float, col: str = "p_change") -> Column:
    """P08."""
    return F.col(col).between(F.lit(lo), F.lit(hi))


def round2(col) -> Column:
    """round half away from zero to 2 places (as numeric rounding)."""
    return F.round(c(col), 2)


# Rounding follows the decimal that a double's shortest text names, as rounding
# of a numeric does; averages are rounded from an exact decimal sum, so the
# result does not depend on the order of addition.
EXACT = "decimal(38,12)"


def _half_away(num: Column, den: Column) -> Column:
    """round(num / den) half away from zero, den > 0, as a double integer; never -0.0."""
    return F.signum(num) * F.floor((F.abs(num) * 2 + den) / (den * 2)) + F.lit(0.0)


def round_fixed(col, places: int = 2) -> Column:
    """half away from zero at ``places`` of the exact decimal."""
    return F.round(c(col).cast("double"), places)


def round_percent(col, places: int = 2) -> Column:
    """F01 of 100 times a fraction: the fraction's exact decimal is scaled, not its double."""
    return F.round(c(col).cast("decimal(38,15)") * 100, places).cast("double")


def avg_round_fixed(col, places: int = 2) -> Column:
    """Aggregate: round(avg(col), places) computed exactly from a decimal sum
    (a partial aggregate like any sum). NULL when the group has no value; a
    mean that rounds to zero from below is 0.0, not -0.0."""
    scaled = (F.sum(c(col).cast(EXACT)) * 10 ** 12).cast("decimal(38,0)")
    n = F.count(c(col))
    step = n.cast("decimal(20,0)") * F.lit(10 ** (12 - places)).cast("decimal(13,0)")
    whole = F.call_function("div", (F.abs(scaled) * 2).cast("decimal(38,0)") + step, (step * 2).cast("decimal(38,0)"))
    return F.when(n > 0, F.signum(scaled.cast("double")) * whole / F.lit(10.0 ** places) + F.lit(0.0))


def ratio_round(num, den, places: int = 2) -> Column:
    """round(num / den, places) of two counts, exact; NULL when den is 0 (Q15)."""
    scale = 10 ** places
    return F.when(c(den) > 0, _half_away(c(num) * F.lit(scale), c(den)) / F.lit(float(scale)))


def percent_text(col, scale: float = 1.0) -> Column:
    """`12.50%` style text with exactly two decimals."""
    return F.format_string("%.2f%%", F.round(c(col) * F.lit(scale), 2))


def label(name: str = "name", code: str = "code") -> Column:
    """name(code)."""
    return F.concat(F.col(name), F.lit("("), F.col(code), F.lit(")"))


def exchange_of(code: str = "code") -> Column:
    """codes starting with 6 trade in SH, others in SZ."""
    return F.when(F.col(code).startswith("6"), F.lit("SH")).otherwise(F.lit("SZ"))


# Fixed value: quote page prefix used in report links.
QUOTE_PAGE = "https://xueqiu.com/S/"


def quote_link(code: str = "code") -> Column:
    """link text of a code's quote page."""
    return F.concat(F.lit(QUOTE_PAGE), exchange_of(code), F.col(code))


def chart_label(code: str = "code", name: str = "name", industry: str = "industry") -> Column:
    """code-name-industry."""
    return F.concat_ws("-", F.col(code), F.col(name), F.col(industry))
