"""Grouped aggregates with the NULL rules of the source tables.

Every aggregate here combines on the map side before it shuffles, so a group that holds a large
part of the rows costs its reducer one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiolume.functions.numbers import ratio
from regiolume.functions.text import ColumnLike, as_col


def strict(total: Column, c: ColumnLike) -> Column:
    """NULL when any input of the group is NULL."""
    return F.when(F.count(as_col(c)) == F.count(F.lit(1)), total)


def strict_sum(c: ColumnLike) -> Column:
    """Sum that is NULL as soon as one input is NULL."""
    return strict(F.sum(as_col(c)), c)


def sum_rest(df: DataFrame, keys: Sequence[str], is_strict: bool = True) -> DataFrame:
    """Sum of every column that is not a key."""
    rest = [c for c in df.columns if c not in keys]
    fn = strict_sum if is_strict else (lambda c: F.sum(as_col(c)))
    return df.groupBy(*keys).agg(*[fn(F.col(f"`{c}`")).alias(c) for c in rest])


def count_filled(df: DataFrame, keys: Sequence[str], c: str, name: str) -> DataFrame:
    """Count of filled values per group; rows with a missing key are left out."""
    return df.na.drop("any", subset=list(keys)).groupBy(*keys).agg(F.count(c).alias(name))


def max_each(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in names])


def sum_when(test: Column, c: ColumnLike) -> Column:
    return F.sum(F.when(test, as_col(c)))


def ratio_of_sums(num: Column, den: Column) -> Column:
    """Quotient of two sums, exact sums divided as doubles."""
    return ratio(F.sum(num).cast("double"), F.sum(den).cast("double"))


def unique_rows(df: DataFrame, keys: Sequence[ColumnLike]) -> DataFrame:
    """Rows whose key occurs exactly once; bulk transactions with a repeated key vanish altogether.

    Only the keys are counted, in a hash aggregation that shrinks repeated keys to one row per map task; the rows of
    the keys that stand alone are then found by a semi join. A missing key equals a missing key.
    """
    named = [as_col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    counts = df.groupBy(*named).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") == 1)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & as_col(k).eqNullSafe(F.col(f"__k{i}"))
    return df.join(counts, same, "left_semi")


def share_within(
    df: DataFrame,
    keys: Sequence[str],
    parts: Sequence[str],
    value: Column,
    digits: int | None = None,
    share_digits: int | None = None,
    names: tuple[str, str, str] = ("estimate", "total", "share"),
) -> DataFrame:
    """Sum per key and part, the key's total, and the part's share of it.

    The raw rows are aggregated once; the total is taken over the aggregated rows, of which a key has
    one per part. With ``digits`` both sums are rounded before they are divided.
    """
    est, tot, share = names
    sums = df.groupBy(*keys, *parts).agg(F.sum(value).alias(est))
    total = F.sum(est).over(Window.partitionBy(*keys))
    out = sums.withColumn(tot, total)
    if digits is not None:
        out = out.withColumn(est, F.bround(est, digits)).withColumn(tot, F.bround(tot, digits))
    quotient = ratio(est, tot)
    return out.withColumn(share, quotient if share_digits is None else F.bround(quotient, share_digits))


def scalars(df: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    """Many single values of one table in one pass, as ``(metric, value)`` rows."""
    one = df.agg(*[c.cast("double").alias(f"m{i}") for i, c in enumerate(aggregates.values())])
    return metric_rows(one, {name: F.col(f"m{i}") for i, name in enumerate(aggregates)})


def metric_rows(one: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Columns of a one-row table as ``(metric, value)`` rows."""
    pairs = [F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in values.items()]
    return one.select(F.inline(F.array(*pairs)))
