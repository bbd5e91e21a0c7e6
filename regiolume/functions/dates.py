"""Dates: the text forms published tables use, anchors, week blocks and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiolume.functions.text import ColumnLike, as_col

SECONDS_PER_YEAR = 31_536_000

MONTHS = ",jan,feb,mar,apr,may,jun,jul,aug,sep,oct,nov,dec"
_SEP = r"[/\-., ]+"
_TWO = r"(\d{1,2})"
_YEAR = r"(\d{4}|\d{2})"
# Shape of each field order and the parts in year-month-day order.
_SHAPES = {
    "mdy": (rf"^{_TWO}{_SEP}{_TWO}{_SEP}{_YEAR}$", "=$3-$1-$2"),
    "ymd": (rf"^(\d{{4}}){_SEP}{_TWO}{_SEP}{_TWO}$", "=$1-$2-$3"),
    "ym": (rf"^(\d{{4}}){_SEP}{_TWO}$", "=$1-$2-1"),
    "my": (rf"^{_TWO}{_SEP}{_YEAR}$", "=$2-$1-1"),
}
# Two-digit years from this one on belong to the last century.
_FIRST_OLD_YEAR = "69"


def parse_date(c: ColumnLike, order: str) -> Column:
    """Text to date; ``order`` is the field order ``mdy``, ``ymd``, ``ym`` or ``my``.

    Any run of slashes, dashes, dots, commas or blanks separates the fields, months may be names, a
    form without a day gets day 1, and text that fits no form gives NULL. The text is brought into
    one form and cast: trying formats one after the other costs an exception per row that fails.
    """
    shape, parts = _SHAPES[order]
    body = F.trim(as_col(c).cast("string"))
    if order in ("mdy", "my"):
        first = F.concat(F.lit(","), F.lower(F.left(body, F.lit(3))))
        number = ((F.position(first, F.lit(MONTHS)) + 3) / 4).cast("int").cast("string")
        body = F.regexp_replace(body, F.lit("^[A-Za-z]{3,9}"), F.concat(number, F.lit("/")))
    # A match starts with "="; a two-digit year is then followed by a dash in the fourth place.
    fitted = F.regexp_replace(body, shape, parts)
    iso = F.regexp_extract(fitted, "^=(.*)$", 1)
    if order in ("mdy", "my"):
        century = F.when(F.substring(fitted, 2, 2) >= _FIRST_OLD_YEAR, "19").otherwise("20")
        short = F.concat(F.substring(fitted, 1, 1), F.substring(fitted, 4, 1)) == "=-"
        iso = F.concat(F.when(short, century).otherwise(""), iso)
    return iso.try_cast("date")


def parse_quarter(c: ColumnLike) -> Column:
    """``2020:Q1``, ``2020 Q1``, ``2020 Quarter 1`` or ``2020.1`` -> first day of that quarter."""
    c = as_col(c)
    shape = r"^\s*(\d{4})\s*[: .\-]?\s*(?:Quarter|Q)?\s*([1-4])\s*$"
    year = F.regexp_extract(c, shape, 1).try_cast("int")
    quarter = F.regexp_extract(c, shape, 2).try_cast("int")
    return quarter_start(year, quarter)


def quarter_start(year: ColumnLike, quarter: ColumnLike) -> Column:
    month = (as_col(quarter).cast("int") - 1) * 3 + 1
    return F.make_date(as_col(year).cast("int"), month, F.lit(1))


def week_block(d: ColumnLike) -> Column:
    """Week number as seven-day blocks counted from 1 January (not ISO weeks)."""
    return (F.floor((F.dayofyear(as_col(d)) - 1) / 7) + 1).cast("int")


def week_to_date(week: ColumnLike, base: str = "2021-01-01") -> Column:
    return F.date_add(F.lit(base).cast("date"), ((as_col(week) - 1) * 7).cast("int"))


def common_year(d: ColumnLike, year: int = 2021) -> Column:
    """Same month and day in one year, to lay years over each other; 29 February gives NULL."""
    return F.date_format(as_col(d), f"'{year}'-MM-dd").try_cast("date")


def anchor_date(year: ColumnLike, month: int = 4, day: int = 1) -> Column:
    return F.make_date(as_col(year).cast("int"), F.lit(month), F.lit(day))


def years_between(start: ColumnLike, end: ColumnLike, digits: int = 1) -> Column:
    """Length of an interval in years of 31 536 000 seconds."""
    days = F.datediff(as_col(end), as_col(start))
    return F.bround(days * F.lit(86_400.0) / SECONDS_PER_YEAR, digits)


def month_name(d: ColumnLike, short: bool = False) -> Column:
    return F.date_format(as_col(d), "MMM" if short else "MMMM")


def month_label(d: ColumnLike, short: bool = False) -> Column:
    """``January-2021``."""
    return F.concat(month_name(d, short), F.lit("-"), F.year(as_col(d)).cast("string"))


def hour_of_label(c: ColumnLike) -> Column:
    """``5am``, ``12pm``, ``Noon``, ``5am_ratio`` or ``5:00 PM`` -> hour of the day 0-23."""
    shape = r"^(\d{1,2})(?::\d{2})?\s*(am|pm)"
    text = F.regexp_replace(F.lower(F.trim(as_col(c))), "^noon", "12pm")
    hour = F.regexp_extract(text, shape, 1).try_cast("int")
    return F.pmod(hour, F.lit(12)) + F.when(F.regexp_extract(text, shape, 2) == "pm", 12).otherwise(0)


def hour_label(hour: ColumnLike) -> Column:
    """5 -> ``5AM``, 12 -> ``12PM``, 17 -> ``5PM``."""
    hour = as_col(hour)
    return (
        F.when(hour < 12, F.concat(hour.cast("string"), F.lit("AM")))
        .when(hour == 12, F.lit("12PM"))
        .when(hour > 12, F.concat((hour - 12).cast("string"), F.lit("PM")))
    )


def clock(hour: ColumnLike) -> Column:
    return F.concat(F.lpad(as_col(hour).cast("string"), 2, "0"), F.lit(":00:00"))


def within_years(d: ColumnLike, first: int, last: int) -> Column:
    """Year test written as a range on the date itself, so that it reaches the file scan."""
    d = as_col(d)
    return (d >= F.lit(f"{first}-01-01").cast("date")) & (d < F.lit(f"{last + 1}-01-01").cast("date"))
