"""Home sales and rents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiolume.functions.dates import month_label, parse_date
from regiolume.functions.numbers import half_even
from regiolume.functions.text import replace_first
from regiolume.operators.reshape import metric_series, unpivot_except


def home_sales(table: DataFrame, period: str = "Month.of.Period.End") -> DataFrame:
    """Price, homes sold and inventory as one tidy series each: ``(month, variable, value)``."""
    rows = table.select(
        parse_date(f"`{period}`", "my").alias("month"),
        F.col("`Median.Sale.Price`").alias("price"), F.col("`Homes.Sold`").alias("sold"), F.col("Inventory").alias("stock"),
    )
    return metric_series(
        rows, "month", {"price": "Median Sales Price", "sold": "Homes Sold", "stock": "Home Inventory"}
    )


def rents(table: DataFrame, region: str) -> DataFrame:
    """One column per month to ``(region, month, estimate)`` for one region."""
    rows = table.filter(F.col("RegionName") == region).drop("RegionID", "SizeRank", "RegionType", "StateName")
    long = unpivot_except(rows, ["RegionName"], "month", "estimate", "double")
    text = replace_first("month", "^X", "")
    day = F.coalesce(parse_date(text, "ymd"), parse_date(text, "ym"))
    return long.select(F.col("RegionName").alias("region"), day.alias("month"), "estimate")


def rents_labelled(table: DataFrame, region: str) -> DataFrame:
    rows = rents(table, region)
    return rows.select(
        F.col("region").alias("geography"), F.col("month").alias("date"), month_label("month").alias("year"),
        half_even("estimate", 0).alias("estimate"),
    )

