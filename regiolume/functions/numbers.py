"""Numbers: parsing, half-even rounding, ratios, bins and bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiolume.functions.text import ColumnLike, as_col


def parse_number(c: ColumnLike, to: str = "int") -> Column:
    """``"1,234"`` -> 1234; text that is no number gives NULL instead of an ANSI error."""
    return F.replace(F.trim(as_col(c).cast("string")), F.lit(","), F.lit("")).try_cast(to)


def sentinel_number(c: ColumnLike, sentinels: Sequence[str] = (".",), to: str = "double") -> Column:
    """Text to number where some texts mean "no value"."""
    c = F.trim(as_col(c))
    return F.when(~c.isin(*sentinels), c.try_cast(to))


def parse_percent(c: ColumnLike) -> Column:
    """``"-5%"`` -> 0.95: a change in percent as an index around one."""
    return F.replace(F.trim(as_col(c)), F.lit("%"), F.lit("")).try_cast("double") / 100 + 1


def half_even(c: ColumnLike, digits: int = 0) -> Column:
    """Round ties to the even neighbour; ``digits`` may be negative."""
    return F.bround(as_col(c), digits)


def ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """Quotient; NULL when the divisor is zero."""
    return F.try_divide(as_col(num), as_col(den))


def pct_change(new: ColumnLike, old: ColumnLike) -> Column:
    new, old = as_col(new), as_col(old)
    return ratio((new - old) * 100, old)


def pct_of(part: ColumnLike, whole: ColumnLike) -> Column:
    return ratio(as_col(part) * 100, whole)


def money(c: ColumnLike) -> Column:
    """Exact type for money, so that sums do not depend on the order the rows arrive in."""
    return as_col(c).cast("decimal(18,2)")


def money_sum(c: ColumnLike) -> Column:
    return F.sum(money(c)).cast("double")


def price_bin(price: ColumnLike, width: float = 50_000, bins: int = 50) -> Column:
    """Half-open bins numbered from 1; 0 when the price is negative, past the last bin or missing."""
    price = as_col(price)
    inside = (price >= 0) & (price < width * bins)
    return F.when(inside, (F.floor(price / width) + 1).cast("int")).otherwise(F.lit(0))


def bands(c: ColumnLike, upper: Sequence[tuple[float, str]], above: str) -> Column:
    """Label by ascending upper bounds, each bound kept in its band; NULL stays NULL."""
    c = as_col(c)
    out = None
    for bound, label in upper:
        out = F.when(c <= bound, label) if out is None else out.when(c <= bound, label)
    return out.when(c > upper[-1][0], above)


def unit_scale(
    value: ColumnLike,
    unit_class: ColumnLike,
    times: Mapping[str, float],
    over: Mapping[str, float] | None = None,
) -> Column:
    """Multiply (or divide) by the number of the row's class; a class without one gives NULL."""
    value, unit_class = as_col(value), as_col(unit_class)
    out = F.when(F.lit(False), value)
    for name, factor in times.items():
        out = out.when(unit_class == name, value * F.lit(float(factor)))
    for name, divisor in (over or {}).items():
        out = out.when(unit_class == name, value / F.lit(float(divisor)))
    return out


def format_label(
    c: ColumnLike, digits: int = 0, prefix: str = "", suffix: str = "", factor: float = 1.0
) -> Column:
    """Number with thousands separators, prefix and suffix; decimals that are all zero are left off."""
    scaled = as_col(c) if factor == 1.0 else as_col(c) * F.lit(factor)
    shown = F.format_number(F.bround(scaled, digits), max(digits, 0))
    if digits > 0:
        shown = F.regexp_replace(F.regexp_replace(shown, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.concat(F.lit(prefix), shown, F.lit(suffix))
