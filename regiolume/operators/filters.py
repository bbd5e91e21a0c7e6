"""Row filters. Tests on dates and parameters are written so that they reach the file scan."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiolume.functions.text import ColumnLike, as_col


def where_equal(df: DataFrame, allowed: Sequence[str], **params: Any) -> DataFrame:
    """Filter by parameters of a view; a list means "one of". Only allowed columns may be named."""
    for name, value in params.items():
        if name not in allowed:
            raise ValueError(f"{name!r} is not one of {list(allowed)}")
        many = isinstance(value, (list, tuple, set))
        df = df.filter(F.col(name).isin(*value) if many else F.col(name) == F.lit(value))
    return df


def exclude_pairs(df: DataFrame, a: str, b: str, pairs: Sequence[tuple[Any, Any]]) -> DataFrame:
    """Drop rows whose two columns equal one of the pairs; a missing value equals nothing."""
    hit = F.lit(False)
    for x, y in pairs:
        hit = hit | (F.col(a).eqNullSafe(F.lit(x)) & F.col(b).eqNullSafe(F.lit(y)))
    return df.filter(~hit)


def drop_any_null(df: DataFrame) -> DataFrame:
    """Drop a row when any of its columns is missing; a number that is NaN is missing."""
    filled = F.lit(True)
    for c, kind in df.dtypes:
        filled = filled & F.col(f"`{c}`").isNotNull()
        if kind in ("double", "float"):
            filled = filled & ~F.isnan(f"`{c}`")
    return df.filter(filled)


def clip_rows(df: DataFrame, c: ColumnLike, low: float | None = None, high: float | None = None) -> DataFrame:
    """Drop outliers; both bounds are kept."""
    c = as_col(c)
    if low is not None:
        df = df.filter(c >= low)
    if high is not None:
        df = df.filter(c <= high)
    return df


def at_extreme(df: DataFrame, c: str, kind: str = "max", within: DataFrame | None = None) -> DataFrame:
    """All rows that hold the largest (smallest) value, ties kept.

    ``within`` limits where the extreme is looked for. The extreme is one aggregated value used as a
    scalar subquery, so no row has to be ranked.
    """
    pick = {"max": F.max, "min": F.min}[kind]
    extreme = (within if within is not None else df).agg(pick(c)).scalar()
    return df.filter(F.col(c) == extreme)


def year_to_date(df: DataFrame, d: str, first_year: int | None = None) -> DataFrame:
    """Keep in every year only the months the latest year has reached."""
    out = df.filter(F.month(d) <= df.agg(F.month(F.max(d))).scalar())
    if first_year is not None:
        out = out.filter(F.col(d) >= F.lit(f"{first_year}-01-01").cast("date"))
    return out


def any_of(tests: Sequence[Column]) -> Column:
    out = tests[0]
    for test in tests[1:]:
        out = out | test
    return out
