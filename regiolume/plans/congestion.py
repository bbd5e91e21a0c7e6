"""Road congestion: share of lane-miles by hour and level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiolume.functions.dates import clock, hour_label, hour_of_label
from regiolume.functions.numbers import bands, ratio
from regiolume.functions.recode import fill_null
from regiolume.operators.aggregate import share_within
from regiolume.operators.project import names_like, quoted
from regiolume.operators.reshape import unpivot_like
from regiolume.plans import rules

RATIO_COLUMN = "_ratio$"


def hourly_ratios(segments: DataFrame, year: str = "year", missing: float | None = 1.0, ratio_digits: int | None = 2) -> DataFrame:
    """Wide segment table (one column per hour) to one row per segment and hour.

    A missing number counts as ``missing`` (a free road); pass ``None`` to leave it missing.
    """
    hours = names_like(segments, RATIO_COLUMN)
    width = F.col("miles") if missing is None else fill_null("miles", missing)
    lanes = F.col("thrulanes") if missing is None else fill_null("thrulanes", missing)
    narrow = segments.select(F.col(year).alias("year"), (width * lanes).alias("lane_miles"), *quoted(hours))
    long = unpivot_like(narrow, RATIO_COLUMN, "label", "ratio", cast="double")
    value: Column = F.col("ratio")
    if missing is not None:
        value = fill_null(value, missing)
    if ratio_digits is not None:
        value = F.bround(value, ratio_digits)
    return long.select("year", hour_of_label("label").alias("hour"), "lane_miles", value.alias("ratio"))


def congestion_shares(
    segments: DataFrame,
    by: str = "level",
    year: str = "year",
    ratio_digits: int | None = 2,
    mile_digits: int | None = 0,
    share_digits: int | None = 2,
) -> DataFrame:
    """Lane-miles and share of all lane-miles by year, hour and congestion level.

    ``by`` is ``level`` (four bands) or ``heavy`` (two). Sums are rounded before they are divided.
    """
    long = hourly_ratios(segments, year, ratio_digits=ratio_digits)
    if by == "level":
        label = bands("ratio", rules.CONGESTION_BANDS, rules.CONGESTION_ABOVE)
    elif by == "heavy":
        label = bands("ratio", [(rules.HEAVY_RATIO, "Heavy Congestion")], "Moderate Congestion")
    else:
        raise ValueError(f"unknown split {by!r}")
    return share_within(
        long.withColumn("level", label), ["year", "hour"], ["level"], F.col("lane_miles"),
        mile_digits, share_digits, ("lane_miles", "total_lane_miles", "share"),
    )


def severe_profile(shares: DataFrame, first_year: int = 2019, level: str = "Severe") -> DataFrame:
    """One level over the day, with the hour as clock text and as label."""
    rows = shares.filter((F.col("level") == level) & (F.col("year") >= first_year))
    return rows.select(
        F.col("year").cast("string").alias("year"), clock("hour").alias("tod"), hour_label("hour").alias("hr"), "share"
    )


def heavy_share_by_hour(
    segments: DataFrame, year: str = "year", threshold: float = rules.HEAVY_RATIO, legacy: bool = False, divisor_year: int = 2020
) -> DataFrame:
    """Lane-miles at or under the threshold per year and hour, and their share of the year's lane-miles.

    Missing ratios count as not congested, so an hour without ratios has 0. Every segment stands once under each hour,
    so the lane-miles of an hour are those of the year, and one aggregation gives both. ``legacy`` sums the ratios instead of the
    lane-miles and divides every year by the lane-miles of ``divisor_year``.
    """
    long = hourly_ratios(segments, year, missing=None, ratio_digits=None)
    measure = F.col("ratio") if legacy else F.col("lane_miles")
    congested = long.groupBy("year", "hour").agg(
        F.coalesce(F.sum(F.when(F.col("ratio") <= threshold, measure)), F.lit(0.0)).alias("congested_miles"),
        F.sum("lane_miles").alias("total"),
    )
    if legacy:
        lane_miles = F.sum(F.col("miles") * F.col("thrulanes"))
        total = segments.filter(F.col(year) == divisor_year).agg(lane_miles).scalar()
        return congested.drop("total").withColumn("share", ratio("congested_miles", total))
    return congested.select("year", "hour", "congested_miles", ratio("congested_miles", "total").alias("share"))
