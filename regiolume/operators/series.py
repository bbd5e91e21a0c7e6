"""Operators over time series. Every window is partitioned by series.

The delta, event and recovery operators expect one row per series and period, as the aggregates
before them produce: a series is then as long as the calendar, however many facts lie behind it. For series
of raw rows the deltas have ``block_rows``; they and ``forward_fill`` cut such series into blocks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiolume.functions.dates import years_between
from regiolume.functions.numbers import pct_change, ratio
from regiolume.operators.ranges import fill_forward, previous_value
from regiolume.operators.reshape import pivot_periods


def _before(
    df: DataFrame, value: str, series: Sequence[str | Column], period: str | Column, block_rows: int | None
) -> DataFrame:
    """The value of the row before as ``__before``; with ``block_rows`` series are cut into blocks instead of standing in
    one task each."""
    if block_rows is None:
        return df.withColumn("__before", F.lag(value).over(Window.partitionBy(*series).orderBy(period)))
    if not isinstance(period, str):
        raise ValueError("a long series is ordered by a column")
    names = [c if isinstance(c, str) else f"__series_{i}" for i, c in enumerate(series)]
    keyed = df.withColumns({n: c for n, c in zip(names, series, strict=True) if not isinstance(c, str)})
    return previous_value(keyed, value, period, names, "__before", block_rows).select(*df.columns, "__before")


def delta_prev(
    df: DataFrame, value: str, series: Sequence[str], period: str | Column, name: str = "delta",
    block_rows: int | None = None,
) -> DataFrame:
    """Change against the previous period of the same series; NULL for its first period. ``block_rows`` is for
    series of raw rows that one task should not hold: they are cut into blocks of about so many rows, see ``ranges``."""
    out = _before(df, value, series, period, block_rows)
    return out.withColumn(name, F.col(value) - F.col("__before")).drop("__before")


def delta_same_month(
    df: DataFrame, value: str, series: Sequence[str], period: str, month: int | None = None, name: str = "delta",
    block_rows: int | None = None,
) -> DataFrame:
    """Change against the same month of the previous year present; ``month`` keeps one month only."""
    if month is not None:
        df = df.filter(F.month(period) == month)
    out = _before(df, value, [*series, F.month(period)], period, block_rows)
    return out.withColumn(name, F.col(value) - F.col("__before")).drop("__before")


def delta_target(
    df: DataFrame, value: str, series: Sequence[str], period: str, target: Any, name: str = "delta",
    block_rows: int | None = None,
) -> DataFrame:
    """The change is kept for the target period only; all other rows hold NULL."""
    out = delta_prev(df, value, series, period, name, block_rows)
    return out.withColumn(name, F.when(F.col(period) == F.lit(target), F.col(name)))


def nearest_period(
    df: DataFrame, value: str, target: Column, keys: Sequence[str] = (), name: str = "diff"
) -> DataFrame:
    """Rows whose value lies closest to a target, ties kept.

    ``target`` is a column or a scalar subquery. Without keys the smallest distance is a scalar
    subquery; with keys it is aggregated per key and joined back.
    """
    far = df.withColumn(name, F.abs(F.col(value) - target))
    if not keys:
        return far.filter(F.col(name) == far.agg(F.min(name)).scalar())
    best = far.groupBy(*keys).agg(F.min(name).alias("__best"))
    return far.join(best, list(keys)).filter(F.col(name) == F.col("__best")).drop("__best")


def compare_periods(
    df: DataFrame, keys: Sequence[str], period: Column, value: Column, periods: dict[str, Any]
) -> DataFrame:
    """Two periods side by side with change, percent change and ratio (second against first)."""
    a, b = periods
    wide = pivot_periods(df, keys, period, value, periods)
    return wide.withColumns({
        "delta": F.col(b) - F.col(a),
        "pct": pct_change(b, a),
        "ratio": ratio(b, a),
    })


def latest_vs_base(
    df: DataFrame, keys: Sequence[str], period: str, value: str, base_years: Mapping[str, int], latest: str = "latest"
) -> DataFrame:
    """The latest period's value next to the same month of other years."""
    last = df.agg(F.max(period)).scalar()
    same_month = F.col(period) == last
    columns = [F.sum(F.when(same_month, F.col(value))).alias(latest)]
    for name, year in base_years.items():
        there = (F.year(period) == year) & (F.month(period) == F.month(last))
        columns.append(F.sum(F.when(there, F.col(value))).alias(name))
    return df.groupBy(*keys).agg(*columns)


def class_growth(
    df: DataFrame, cls: str | Column, year: Column, value: Column, first: Any, last: Any, name: str = "delta"
) -> DataFrame:
    """Sum per class for two years and their difference, in one pass; classless rows are left out."""
    c = F.col(cls) if isinstance(cls, str) else cls.alias("class")
    label = cls if isinstance(cls, str) else "class"
    rows = df.select(c, year.alias("__y"), value.alias("__v")).filter(
        F.col(label).isNotNull() & F.col("__y").isin(first, last)
    )
    return rows.groupBy(label).agg(
        F.sum(F.when(F.col("__y") == first, F.col("__v"))).alias("first"),
        F.sum(F.when(F.col("__y") == last, F.col("__v"))).alias("last"),
    ).withColumn(name, F.col("last") - F.col("first"))


def forward_fill(
    df: DataFrame,
    c: str,
    order: str,
    series: Sequence[str] = (),
    block: Column | None = None,
) -> DataFrame:
    """Fill missing values of a column with the last filled one before them.

    Series of any length and order are cut into blocks of about equal size, see ``ranges``. ``block`` names the pieces
    instead, where the rows have some that follow each other in the order: each piece is filled on its own and what it
    inherits comes from one row per earlier piece.
    """
    if block is None:
        return fill_forward(df, c, order, series)
    keyed = df.withColumn("__block", block)
    tails = keyed.groupBy(*series, "__block").agg(
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias("__tail")
    )
    earlier = Window.partitionBy(*series).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    # What a piece inherits goes in front of it as one more row, so no join is needed.
    heads = tails.select(
        *series, "__block", F.last("__tail", True).over(earlier).alias(c), F.lit(0).alias("__real")
    )
    both = keyed.withColumn("__real", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    inside = (
        Window.partitionBy(*series, "__block")
        .orderBy("__real", order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return both.withColumn(c, F.last(c, True).over(inside)).filter(F.col("__real") == 1).select(*df.columns)


@dataclass(frozen=True)
class Event:
    """A fall from a peak: which periods its curve covers and where the search for the return starts."""

    name: str
    peak: str
    end: str | None = None
    with_peak: bool = False
    below_peak: bool = True
    search_from: str | None = None


def _spread(df: DataFrame, period: str, events: Sequence[Event]) -> DataFrame:
    """Each row once per event it can belong to; events are few and written in the program."""
    marks = F.array(*[
        F.struct(
            F.lit(e.name).alias("event"),
            F.lit(e.peak).cast("date").alias("peak"),
            F.lit(e.end).cast("date").alias("until"),
            F.lit(e.with_peak).alias("with_peak"),
            F.lit(e.below_peak).alias("below_peak"),
            F.lit(e.search_from or e.peak).cast("date").alias("search_from"),
        )
        for e in events
    ])
    first = min(e.peak for e in events)
    rows = df.filter(F.col(period) >= F.lit(first).cast("date"))
    return rows.select("*", F.explode(marks).alias("m")).select(*df.columns, "m.*").filter(
        F.col(period) >= F.col("peak")
    )


def _level(series: Sequence[str], period: str, value: str, digits: int | None) -> Column:
    level = F.max(F.when(F.col(period) == F.col("peak"), F.col(value))).over(
        Window.partitionBy(*series, "event")
    )
    return level if digits is None else F.bround(level, digits)


def event_curves(
    df: DataFrame, series: Sequence[str], period: str, value: str, events: Sequence[Event], level_digits: int | None = -1
) -> DataFrame:
    """Curves of several falls lined up by the number of periods since their peak."""
    rows = _spread(df, period, events).withColumn("level", _level(series, period, value, level_digits))
    kept = rows.filter(
        (F.col("with_peak") | (F.col(period) > F.col("peak")))
        & (~F.col("below_peak") | (F.col(value) <= F.col("level")))
        & (F.col("until").isNull() | (F.col(period) <= F.col("until")))
    )
    order = Window.partitionBy(*series, "event").orderBy(period)
    return kept.withColumn("index", F.row_number().over(order)).select(
        *series, "event", period, value, "index"
    )


def return_to_peak(
    df: DataFrame,
    series: Sequence[str],
    period: str,
    value: str,
    events: Sequence[Event],
    level_digits: int | None = -1,
    legacy: bool = False,
) -> DataFrame:
    """First period that reaches the peak's level again, and the years until then.

    The search starts after the first period below the level, so the peak itself never counts.
    ``legacy`` starts at the event's ``search_from`` instead, which may be the peak.
    """
    rows = _spread(df, period, events).withColumn("level", _level(series, period, value, level_digits))
    w = Window.partitionBy(*series, "event")
    if legacy:
        start, after = F.col("search_from"), F.col(period) >= F.col("__start")
    else:
        start = F.min(F.when(F.col(value) < F.col("level"), F.col(period))).over(w)
        after = F.col(period) > F.col("__start")
    back = F.when(after & (F.col(value) >= F.col("level")), F.col(period))
    out = rows.withColumn("__start", start).groupBy(*series, "event").agg(
        F.first("peak").alias("peak"), F.max("level").alias("level"), F.min(back).alias("returned")
    )
    return out.withColumn("years", years_between("peak", "returned"))
