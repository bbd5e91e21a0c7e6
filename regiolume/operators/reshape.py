"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiolume.operators.project import names_like, quoted


def _melt(df: DataFrame, cols: Sequence[str], names_to: str, values_to: str, cast: str | None) -> DataFrame:
    ids = [c for c in df.columns if c not in set(cols)]
    if not cols:
        raise ValueError("no column to turn into rows")
    # Values travel as one array per row and names as one constant: the generated code stays small
    # for hundreds of columns, where one projection per column outgrows code generation.
    values = F.array(*[F.col(f"`{c}`").cast(cast) if cast else F.col(f"`{c}`") for c in cols])
    long = df.select(*quoted(ids), F.posexplode(values).alias("__at", "__value"))
    name = F.get(F.array(*[F.lit(c) for c in cols]), F.col("__at"))
    return long.select(*quoted(ids), name.alias(names_to), F.col("__value").alias(values_to))


def unpivot_like(
    df: DataFrame, pattern: str, names_to: str = "name", values_to: str = "value", cast: str | None = None
) -> DataFrame:
    """Columns whose name holds the pattern become rows; the others are repeated."""
    return _melt(df, names_like(df, pattern), names_to, values_to, cast)


def unpivot_except(
    df: DataFrame, ids: Sequence[str], names_to: str = "name", values_to: str = "value", cast: str | None = None
) -> DataFrame:
    return _melt(df, [c for c in df.columns if c not in set(ids)], names_to, values_to, cast)


def metric_series(df: DataFrame, period: str, metrics: dict[str, str]) -> DataFrame:
    """Several measures of one table as one tidy series each: ``(period, variable, value)``."""
    wide = df.select(period, *[F.col(f"`{c}`").cast("double").alias(label) for c, label in metrics.items()])
    return _melt(wide, list(metrics.values()), "variable", "value", None)


def split_into(df: DataFrame, c: str, into: Sequence[str], pattern: str, drop: bool = True) -> DataFrame:
    """Split a text column; pieces past the list are dropped, pieces that are missing are NULL."""
    pieces = F.split(F.col(f"`{c}`"), pattern)
    rest = [x for x in df.columns if not (drop and x == c)]
    return df.select(
        *[F.col(f"`{x}`") for x in rest if x not in into],
        *[F.get(pieces, F.lit(i)).alias(n) for i, n in enumerate(into)],
    )


def pivot_periods(
    df: DataFrame, keys: Sequence[str], period: Column, value: Column, periods: dict[str, object]
) -> DataFrame:
    """Chosen periods side by side, summed in one pass without a join: ``{new column: period}``."""
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(period == F.lit(p), value)).alias(name) for name, p in periods.items()
    ])
