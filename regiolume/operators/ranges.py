"""Blocks of neighbouring rows in any order: long series are worked on block by block, each in a task of its own.

The block of a row is a function of the row: the number of bounds at or below its key. Bounds are keys of a sample of the rows,
so blocks are about equally large whether the order is a dense or a sparse number, a date or a text. Only
balance depends on the sample; results never do. What one block needs from those before it is one row of each.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

#: Rows that a block should hold, and the most bounds that a plan carries.
BLOCK_ROWS, MOST_BOUNDS = 100_000, 2_000
#: Sampled rows for each block.
_SAMPLED = 20


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])


def _literal(value, kind: DataType) -> Column:
    """A value of a sampled row, nested or not, as a constant."""
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, StructType):
        return F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields, strict=True)])
    if isinstance(kind, ArrayType):
        return F.array(*[_literal(v, kind.elementType) for v in value]).cast(kind)
    return F.lit(value).cast(kind)


def range_block(df: DataFrame, keys: Sequence[str], rows: int = BLOCK_ROWS, seed: int = 17) -> Column:
    """The number of a row's block when all rows are ordered by ``keys``: 0, 1, ... in that order, missing keys first.

    Counts the rows and samples keys (some tens of thousands at most) while the plan is built. Rows of equal keys are
    in one block. A table of few rows is one block.
    """
    total = df.count()
    blocks = min(MOST_BOUNDS + 1, math.ceil(total / rows))
    if blocks < 2:
        return F.lit(0)
    share = min(1.0, _SAMPLED * blocks / total)
    kinds = [df.schema[k].dataType for k in keys]
    sample = df.select(*[F.col(f"`{k}`") for k in keys]).sample(share, seed).distinct().orderBy(
        *[F.asc_nulls_first(F.col(f"`{k}`")) for k in keys]
    ).collect()
    picked = sorted({i * len(sample) // blocks for i in range(1, blocks)} - {0}) if sample else []
    if not picked:
        return F.lit(0)
    bounds = F.array(*[
        F.struct(*[_literal(v, kind).alias(f"k{i}") for i, (v, kind) in enumerate(zip(sample[at], kinds, strict=True))])
        for at in picked
    ])
    # Halving steps: the number of bounds at or below the key.
    steps = [1 << b for b in range(len(picked).bit_length() - 1, -1, -1)]

    def step(passed: Column, size: Column) -> Column:
        ahead = passed + size
        bound = F.get(bounds, ahead - 1)
        return F.when((ahead <= len(picked)) & (bound <= _key(keys)), ahead).otherwise(passed)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def _window(series: Sequence[str], *order: str):
    return Window.partitionBy(*[F.col(f"`{s}`") for s in series]).orderBy(*[F.asc_nulls_first(F.col(f"`{o}`")) for o in order])


def _inherited(tails: DataFrame, series: Sequence[str], nearest: bool) -> DataFrame:
    """What each block inherits, in ``__carried``: the ``__tail`` of the block before, or of the nearest that has one.

    Without series the blocks, ``MOST_BOUNDS`` + 1 of them at most, are the entries of one array instead of a window's rows.
    """
    if series:
        w = _window(series, "__block")
        before = F.last("__tail", True).over(w.rowsBetween(Window.unboundedPreceding, -1)) if nearest else F.lag("__tail").over(w)
        return tails.withColumn("__carried", before).drop("__tail")
    entries = F.array_sort(F.collect_list(F.struct("__block", "__tail")), lambda a, b: a["__block"] - b["__block"])
    some = F.filter("__entries", lambda e: e["__tail"].isNotNull()) if nearest else F.col("__entries")
    found = tails.agg(entries.alias("__entries")).withColumn("__some", some).select("__some", F.explode("__entries.__block").alias("__block"))
    earlier = F.filter("__some", lambda e: e["__block"] < F.col("__block"))
    return found.select("__block", F.get(earlier, F.size(earlier) - 1)["__tail"].alias("__carried"))


def _with_heads(df: DataFrame, order: Sequence[str], series: Sequence[str], rows: int, carried: Column, nearest: bool) -> tuple[DataFrame, Window]:
    """Rows with their block and, before each block of a series, one more row (``__real`` 0) with what it inherits.

    ``carried`` is an aggregate over a block; the head row holds in ``__carried`` that of the block before or, ``nearest``, of the
    nearest that has one. Heads stand in front by ``__real``, so that no join is needed.
    """
    keyed = df.withColumn("__block", range_block(df, [*series, *order], rows))
    tails = keyed.groupBy(*[F.col(f"`{s}`") for s in series], "__block").agg(carried.alias("__tail"))
    heads = _inherited(tails, series, nearest).withColumn("__real", F.lit(0))
    both = keyed.withColumn("__real", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    return both, _window([*series, "__block"], "__real", *order)


def fill_forward(df: DataFrame, c: str, order: str | Sequence[str], series: Sequence[str] = (), rows: int = BLOCK_ROWS) -> DataFrame:
    """Missing values of a column filled with the last filled one before them, in any order.

    A series of any length is cut into blocks; a block inherits the last filled value of all blocks before it. Rows
    of equal order are filled in no particular order among themselves.
    """
    order = [order] if isinstance(order, str) else list(order)
    some = F.when(F.col(f"`{c}`").isNotNull(), F.struct(*[F.col(f"`{o}`") for o in order]))
    both, inside = _with_heads(
        df, order, series, rows, F.max_by(F.col(f"`{c}`"), some), nearest=True
    )
    own = F.coalesce(F.col(f"`{c}`"), F.col("__carried"))
    filled = F.last(own, True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("__filled", filled).filter("__real = 1").select(
        *[F.col("__filled").alias(x) if x == c else F.col(f"`{x}`") for x in df.columns]
    )


def previous_value(
    df: DataFrame, c: str, order: str | Sequence[str], series: Sequence[str] = (), name: str = "previous", rows: int = BLOCK_ROWS
) -> DataFrame:
    """The value that a column has in the row before, missing or not: ``lag`` for series that are longer than a task.

    Blocks hand on their last row, so the first row of a block finds the one before it. A series' first row has none.
    """
    order = [order] if isinstance(order, str) else list(order)
    place = F.struct(*[F.col(f"`{o}`") for o in order])
    both, inside = _with_heads(
        df, order, series, rows, F.max_by(F.struct(F.col(f"`{c}`").alias("v")), place), nearest=False
    )
    value = F.when(F.col("__real") == 0, F.col("__carried.v")).otherwise(F.col(f"`{c}`"))
    out = both.withColumn("__value", value).withColumn("__before", F.lag("__value").over(inside)).filter("__real = 1")
    return out.select(*[F.col(f"`{x}`") for x in df.columns if x != name], F.col("__before").alias(name))
