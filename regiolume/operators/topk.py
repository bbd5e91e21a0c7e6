"""Ordering and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiolume.functions.recode import category_rank


def top_n(df: DataFrame, by: str, n: int = 10, ties: Sequence[str] = ()) -> DataFrame:
    """The n largest rows; each task keeps n rows before the merge. ``ties`` makes the choice stable."""
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(n)


def top_n_per_group(df: DataFrame, group: Sequence[str], by: str, n: int = 10, ties: Sequence[str] = ()) -> DataFrame:
    """The n largest rows of every group, with their rank.

    Spark limits each group inside each task before the shuffle, so a large group never moves whole.
    """
    order = Window.partitionBy(*group).orderBy(F.col(by).desc_nulls_last(), *ties)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def order_by_levels(df: DataFrame, c: str, levels: Sequence[str], *then: str | Column) -> DataFrame:
    """Sort by the place of a value in an ordered category; values outside the levels come last."""
    return df.orderBy(category_rank(c, levels).asc_nulls_last(), *then)


def order_by_measure(df: DataFrame, measure: str, *then: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc_nulls_last(), *then)


def slice_rows(df: DataFrame, first: int, last: int | None, order: str = "pos", per: Sequence[str] = ("file",)) -> DataFrame:
    """Rows ``first``..``last`` of each file by position, counted from 1 over the rows that are left.

    Spark keeps at most ``last`` rows per file in each task. Without a last row only the position of row ``first`` is
    looked for in that way, one row per file, and the rows from there on are kept where they are.
    """
    if last is None and first <= 1:
        return df
    place = F.row_number().over(Window.partitionBy(*per).orderBy(order))
    if last is not None:
        out = df.withColumn("__place", place).filter(F.col("__place") <= last)
        return out.filter(F.col("__place") >= first).drop("__place")
    named = {k: f"__file_{i}" for i, k in enumerate(per)}
    starts = df.select(*per, order).withColumn("__place", place).filter(F.col("__place") <= first)
    starts = starts.filter(F.col("__place") == first).select(
        *[F.col(k).alias(name) for k, name in named.items()], F.col(order).alias("__start")
    )
    test = F.col(order) >= F.col("__start")
    for k, name in named.items():
        test = F.col(k).eqNullSafe(F.col(name)) & test
    return df.join(starts, test).select(df.columns)
