"""Column selection by name, pattern, position and parameter."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def names_like(df: DataFrame, pattern: str, negate: bool = False) -> list[str]:
    """Column names that hold the pattern, in table order."""
    rx = re.compile(pattern)
    return [c for c in df.columns if bool(rx.search(c)) != negate]


def quoted(names: Iterable[str]) -> list[Column]:
    """Columns by exact name, also when the name holds dots."""
    return [F.col(f"`{n}`") for n in names]


def select_like(df: DataFrame, pattern: str, negate: bool = False) -> DataFrame:
    return df.select(*quoted(names_like(df, pattern, negate)))


def drop_like(df: DataFrame, pattern: str) -> DataFrame:
    return select_like(df, pattern, negate=True)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*quoted(c for c in df.columns if c not in set(names)))


def select_positions(df: DataFrame, first: int, last: int | None = None) -> DataFrame:
    """Columns ``first``..``last`` counted from 1, both kept."""
    return df.select(*quoted(df.columns[first - 1:last]))


def select_metric(df: DataFrame, keep: Sequence[str], metric: str, allowed: Sequence[str], name: str = "value") -> DataFrame:
    """The measure is a parameter: it must be one of the allowed columns."""
    if metric not in allowed:
        raise ValueError(f"{metric!r} is not one of {list(allowed)}")
    return df.select(*quoted(keep), F.col(f"`{metric}`").alias(name))


def across(df: DataFrame, names: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    """One expression applied to many columns in a single projection."""
    todo = set(names)
    return df.select(*[
        fn(F.col(f"`{c}`")).alias(c) if c in todo else F.col(f"`{c}`") for c in df.columns
    ])


def distinct_values(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*quoted(names)).distinct() if names else df.distinct()
