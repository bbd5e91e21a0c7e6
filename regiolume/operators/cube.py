"""One table of aggregates for many views: grouping sets with states that can be merged.

A cube row holds, for one combination of keys of one grouping set, the states of a measure: rows, filled rows, sum, smallest and
largest. New rows make a cube of their own, which is merged with the stored one: what is already there is never
computed again. A view is a look-up of some rows of one set.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATES = ("n", "filled", "total", "least", "most")


def build_cube(df: DataFrame, sets: Mapping[str, Sequence[str]], value: str) -> DataFrame:
    """``set``, all keys of all sets (NULL where a set does not have the key) and the states of ``value``.

    All sets come from one scan and one aggregation, combined in the map tasks. A key that is missing in the data stays
    apart from a key that a set does not have, as ``set`` tells which keys count.
    """
    keys = list(dict.fromkeys(k for names in sets.values() for k in names))
    v = F.col(f"`{value}`")
    grouped = df.groupingSets([[F.col(f"`{k}`") for k in names] for names in sets.values()], *[F.col(f"`{k}`") for k in keys])
    states = grouped.agg(
        F.grouping_id().alias("__id"), F.count(F.lit(1)).alias("n"), F.count(v).alias("filled"), F.sum(v).alias("total"),
        F.min(v).alias("least"), F.max(v).alias("most"),
    )
    name = F.lit(None).cast("string")
    for label, names in sets.items():
        absent = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in names)
        name = F.when(F.col("__id") == absent, F.lit(label)).otherwise(name)
    return states.select(name.alias("set"), *[F.col(f"`{k}`") for k in keys], *STATES)


def merge_cubes(*cubes: DataFrame) -> DataFrame:
    """The cube of all rows together, from the cubes of their parts."""
    both = cubes[0]
    for more in cubes[1:]:
        both = both.unionByName(more)
    keys = [F.col(f"`{c}`") for c in both.columns if c not in STATES]
    return both.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("filled").alias("filled"), F.sum("total").cast(both.schema["total"].dataType).alias("total"),
        F.min("least").alias("least"), F.max("most").alias("most"),
    )


def look_up(cube: DataFrame, name: str, keys: Sequence[str], where: Mapping[str, Any] | None = None) -> DataFrame:
    """Rows of one set with the ``keys`` asked for, where other keys have given values (None: missing)."""
    rows = cube.filter(F.col("set") == name)
    for key, wanted in (where or {}).items():
        rows = rows.filter(F.col(f"`{key}`").eqNullSafe(F.lit(wanted)))
    return rows.select(*[F.col(f"`{k}`") for k in keys], *STATES)


def strict_total() -> Column:
    """The sum, missing where a row of the group has no value."""
    return F.when(F.col("filled") == F.col("n"), F.col("total"))


def mean() -> Column:
    return F.when(F.col("filled") > 0, F.col("total").cast("double") / F.col("filled"))
