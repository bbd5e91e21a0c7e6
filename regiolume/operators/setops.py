"""Stacking tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame


def stack(*tables: DataFrame) -> DataFrame:
    """Union all by name; a column one table lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def cut_over(early: DataFrame, late: DataFrame, before: Column, keep_late: Column) -> DataFrame:
    """Two deliveries that overlap in time: the early one up to the cut, the late one from its start."""
    return stack(early.filter(before), late.filter(keep_late))

