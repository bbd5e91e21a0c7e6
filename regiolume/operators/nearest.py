"""Nearest values for a whole table of targets: no cross join, no series in one task.

Targets and values are put into one order; each target's neighbours are the last value at or before it and the first at
or after it, filled in from both sides block by block (see ``ranges``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiolume.operators.joins import left_join
from regiolume.operators.ranges import BLOCK_ROWS, fill_forward, previous_value


def _closest(value: Column, low: Column, high: Column) -> Column:
    """The one or two of the neighbours that are closest, as an array; their distance is the same."""
    below, above = value - low, high - value
    return (
        F.when(low.isNull() & high.isNull(), F.array().cast("array<double>"))
        .when(high.isNull() | (below < above), F.array(low))
        .when(low.isNull() | (above < below), F.array(high))
        .otherwise(F.array_distinct(F.array(low, high)))
    )


def _both_sides(points: DataFrame, c: str, keys: Sequence[str], step, rows: int) -> DataFrame:
    """``__low`` and ``__high`` of each point by a step in the order of ``__v`` and one in the reverse order."""
    there = step(points.withColumn("__low", F.col(c)), "__low", "__v", keys, rows)
    return step(there.withColumns({"__high": F.col(c), "__back": -F.col("__v")}), "__high", "__back", keys, rows)


def nearest_rows(
    values: DataFrame, targets: DataFrame, value: str, keys: Sequence[str] = (), name: str = "diff", rows: int = BLOCK_ROWS
) -> DataFrame:
    """For each target all rows of ``values`` whose value lies closest to the target's, ties kept.

    Both tables have ``keys`` and ``value``; neighbours have equal keys (a missing key equals a missing key). Returns the
    columns of the targets, the values' other columns under ``near_<column>`` and the distance. A target without value or without
    any value of its key has no row. Numbers are compared as doubles.
    """
    keys, v = list(keys), F.col(f"`{value}`").cast("double")
    known = lambda df, flag: df.filter(v.isNotNull() & ~F.isnan(v)).select(*keys, v.alias("__v"), F.lit(flag).alias("__is"))
    points = known(values, True).unionByName(known(targets, False)).groupBy(*keys, "__v").agg(F.max("__is").alias("__is"))
    points = points.withColumn("__own", F.when(F.col("__is"), F.col("__v")))
    sides = _both_sides(points, "__own", keys, fill_forward, rows)
    near = sides.select(*keys, "__v", F.explode(_closest(F.col("__v"), F.col("__low"), F.col("__high"))).alias("__near"))
    return _joined(values, targets, near, value, keys, name)


def nearest_other(
    df: DataFrame, value: str, period: str, keys: Sequence[str] = (), name: str = "diff", rows: int = BLOCK_ROWS
) -> DataFrame:
    """For each row the other rows whose value lies closest, ties kept; rows of its own ``period`` are not others.

    Where two periods share a value they are each other's nearest; a value that stands alone has its neighbours on both sides.
    Columns as ``nearest_rows`` gives them. Rows without value, and rows without any other of their keys, are left out.
    """
    keys, v = list(keys), F.col(f"`{value}`").cast("double")
    known = df.filter(v.isNotNull() & ~F.isnan(v))
    points = known.groupBy(*keys, v.alias("__v")).agg(
        F.coalesce(F.min(period) != F.max(period), F.lit(False)).alias("__shared")
    )
    sides = _both_sides(points, "__v", keys, lambda d, c, o, k, n: previous_value(d, c, o, k, c, n), rows)
    closest = F.when(F.col("__shared"), F.array("__v")).otherwise(_closest(F.col("__v"), F.col("__low"), F.col("__high")))
    near = sides.select(*keys, "__v", F.explode(closest).alias("__near"))
    found = _joined(df, df, near, value, keys, name)
    return found.filter(F.col(f"`{period}`") != F.col(f"`near_{period}`"))


def _joined(values: DataFrame, targets: DataFrame, near: DataFrame, value: str, keys: list[str], name: str) -> DataFrame:
    """Targets next to their nearest values (one or two), and these next to the rows that have them."""
    asked = targets.withColumn("__v", F.col(f"`{value}`").cast("double")).filter("__v is not null")
    matched = left_join(asked, near.groupBy(*keys, "__v").agg(F.collect_set("__near").alias("__nears")), [*keys, "__v"])
    spread = matched.select("*", F.explode("__nears").alias("__near")).drop("__nears")
    others = {c: f"near_{c}" for c in values.columns if c not in keys}
    side = values.select(
        *[F.col(f"`{k}`").alias(f"__key_{i}") for i, k in enumerate(keys)], F.col(f"`{value}`").cast("double").alias("__other"),
        *[F.col(f"`{c}`").alias(near_c) for c, near_c in others.items()],
    )
    on = F.col("__near") == F.col("__other")
    for i, k in enumerate(keys):
        on = on & F.col(f"`{k}`").eqNullSafe(F.col(f"__key_{i}"))
    return spread.join(side, on).select(
        *[F.col(f"`{c}`") for c in targets.columns], *[F.col(f"`{c}`") for c in others.values()],
        F.abs(F.col("__near") - F.col("__v")).alias(name),
    )
