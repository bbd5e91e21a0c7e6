"""The data side of every chart: one tidy table ``(x, y, group, facet, label)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiolume.functions.numbers import format_label
from regiolume.functions.recode import category_rank


def chart_dataset(
    df: DataFrame,
    x: str,
    y: str,
    group: str,
    facet: str | None = None,
    digits: int = 0,
    factor: float = 1.0,
    prefix: str = "",
    suffix: str = "",
    levels: Sequence[str] | None = None,
) -> DataFrame:
    """Columns by name as a chart helper takes them, with the tooltip's text.

    With ``levels`` the group is an ordered category: ``place`` is its order, and a group that is
    none of the levels has none.
    """
    out = df.select(
        F.col(f"`{x}`").alias("x"), F.col(f"`{y}`").alias("y"), F.col(f"`{group}`").cast("string").alias("group"),
        (F.col(f"`{facet}`") if facet else F.lit(None)).cast("string").alias("facet"),
        F.concat(
            F.col(f"`{group}`").cast("string"), F.lit(": "), format_label(f"`{y}`", digits, prefix, suffix, factor)
        ).alias("label"),
    )
    return out if levels is None else out.withColumn("place", category_rank("group", levels))
