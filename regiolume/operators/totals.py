"""Rows derived from other rows of the same table: totals, regions, merged and residual categories.

The fact rows are aggregated once to the finest grain; every derived row is computed from that small
result, so adding levels adds no scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiolume.functions.recode import not_in_keep_null
from regiolume.functions.text import strip_part_suffix
from regiolume.operators.aggregate import strict_sum
from regiolume.operators.setops import stack


def _sums(values: Sequence[str], is_strict: bool) -> list[Column]:
    return [(strict_sum(v) if is_strict else F.sum(v)).alias(v) for v in values]


def add_rollup(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    into: Mapping[str, Any],
    members: Column | None = None,
    is_strict: bool = True,
) -> DataFrame:
    """Sum per key plus, for rows that pass ``members``, sums under changed keys.

    ``into`` gives the keys of the derived rows: a constant or an expression over the keys. Derived rows are added below the
    others: a row that already has such a key stays as it is, beside the derived one.
    """
    base = df.groupBy(*keys).agg(*_sums(values, is_strict))
    moved = F.struct(*[
        (into[k] if isinstance(into[k], Column) else F.lit(into[k])).alias(k) if k in into else F.col(k)
        for k in keys
    ])
    parts = base if members is None else base.filter(members)
    derived = parts.select(moved.alias("__key"), *values).select("__key.*", *values)
    return stack(base, derived.groupBy(*keys).agg(*_sums(values, is_strict)).select(base.columns))


def add_total(
    df: DataFrame, keys: Sequence[str], dim: str, values: Sequence[str], label: str = "Total", is_strict: bool = True
) -> DataFrame:
    """Rows per key and category plus a total row per key, by grouping sets over the aggregated rows.

    ``grouping`` tells a total row from a category that is missing.
    """
    base = df.groupBy(*keys, dim).agg(*_sums(values, is_strict))
    full = [F.col(k) for k in [*keys, dim]]
    sets = base.groupingSets([full, full[:-1]], *full)
    out = sets.agg(*_sums(values, is_strict), F.grouping(dim).alias("__total"))
    named = F.when(F.col("__total") == 1, F.lit(label)).otherwise(F.col(dim))
    return out.withColumn(dim, named).drop("__total")


def add_region(
    df: DataFrame,
    area: str,
    keys: Sequence[str],
    values: Sequence[str],
    label: str = "Region",
    outside: Sequence[str] = (),
    is_strict: bool = True,
) -> DataFrame:
    """Area rows plus rows for the region: the sum of its member areas.

    Areas named ``outside`` (the state) stay out of the region; an area without a name counts in.
    """
    members = not_in_keep_null(area, list(outside)) if outside else None
    return add_rollup(df, [area, *keys], values, {area: label}, members, is_strict)


def add_region_levels(
    df: DataFrame,
    level: str,
    area: str,
    keys: Sequence[str],
    values: Sequence[str],
    labels: Mapping[Any, str],
    is_strict: bool = True,
) -> DataFrame:
    """Region rows per level code, each level under its own label; other levels give no region row.

    Levels are summed apart: adding them up would count places twice.
    """
    name = F.lit(None).cast("string")
    for code, label in labels.items():
        name = F.when(F.col(level) == F.lit(code), label).otherwise(name)
    return add_rollup(
        df, [level, area, *keys], values, {area: name}, F.col(level).isin(*labels), is_strict
    )


def merge_buckets(
    df: DataFrame,
    bucket: str,
    keys: Sequence[str],
    values: Sequence[str],
    merges: Mapping[str, Sequence[str]],
    keep_parts: bool = True,
    is_strict: bool = True,
) -> DataFrame:
    """Coarser buckets from finer ones: ``{new bucket: [parts]}``."""
    name = F.lit(None).cast("string")
    for label, parts in merges.items():
        name = F.when(F.col(bucket).isin(*parts), label).otherwise(name)
    if keep_parts:
        return add_rollup(df, [bucket, *keys], values, {bucket: name}, name.isNotNull(), is_strict)
    merged = df.withColumn(bucket, F.coalesce(name, F.col(bucket)))
    return merged.groupBy(bucket, *keys).agg(*_sums(values, is_strict))


def merge_parts(
    df: DataFrame, place: str, keys: Sequence[str], values: Sequence[str], is_strict: bool = True
) -> DataFrame:
    """One row per place from its parts: the part suffix goes, the parts are summed."""
    return (
        df.withColumn(place, strip_part_suffix(place))
        .groupBy(place, *keys)
        .agg(*_sums(values, is_strict))
    )


def residual_rows(
    df: DataFrame,
    category: str,
    keys: Sequence[str],
    value: str,
    total: str,
    named: Sequence[str],
    label: str,
) -> DataFrame:
    """The category that is not published: the published total less the named categories.

    One conditional aggregation; keys without a total row give no residual.
    """
    whole, part = F.col(category) == total, F.col(category).isin(*named)
    sums = df.filter(whole | part).groupBy(*keys).agg(
        F.count(F.when(whole, 1)).alias("__totals"),
        F.sum(F.when(whole, F.col(value))).alias("__whole"),
        F.when(
            F.count(F.when(part, F.col(value))) == F.count(F.when(part, 1)), F.sum(F.when(part, F.col(value)))
        ).alias("__part"),
    )
    return sums.filter(F.col("__totals") > 0).select(
        *keys, F.lit(label).alias(category), (F.col("__whole") - F.col("__part")).alias(value)
    )
