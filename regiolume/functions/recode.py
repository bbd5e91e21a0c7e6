"""Recoding and NULL rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiolume.functions.text import ColumnLike, as_col


def case_when(rules: Iterable[tuple[Column, Any]], default: Any = None) -> Column:
    """First matching rule wins; without a default an unmatched row gives NULL."""
    out = F
    for test, value in rules:
        out = out.when(test, value)
    return out if default is None else out.otherwise(default)


def last_match(rules: Sequence[tuple[Column, Any]], default: Any) -> Column:
    """Overwrite rules applied top to bottom: the last one that matches wins."""
    return case_when(list(reversed(list(rules))), default)


def exact_map(c: ColumnLike, mapping: Mapping[str, Any], default: Any = None) -> Column:
    c = as_col(c)
    return case_when([(c == key, value) for key, value in mapping.items()], default)


def fill_null(c: ColumnLike, value: Any) -> Column:
    return F.coalesce(as_col(c), F.lit(value))


def null_if(c: ColumnLike, value: Any) -> Column:
    return F.nullif(as_col(c), F.lit(value))


def not_in_keep_null(c: ColumnLike, values: Sequence[Any]) -> Column:
    """``NOT IN`` that keeps rows whose value is missing."""
    return ~F.coalesce(as_col(c).isin(*values), F.lit(False))


def category_rank(c: ColumnLike, levels: Sequence[str]) -> Column:
    """Position of a value in an ordered list of categories; NULL when it is none of them."""
    rank = F.array_position(F.array(*[F.lit(x) for x in levels]), as_col(c)).cast("int")
    return F.nullif(rank, F.lit(0))
