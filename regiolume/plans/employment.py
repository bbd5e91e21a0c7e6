"""Jobs by sector and area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiolume.functions.dates import month_label, parse_date
from regiolume.functions.recode import category_rank
from regiolume.functions.text import replace_all
from regiolume.operators.filters import at_extreme
from regiolume.operators.reshape import unpivot_like
from regiolume.operators.series import delta_prev, delta_same_month
from regiolume.operators.setops import stack
from regiolume.operators.totals import add_region, residual_rows
from regiolume.plans import rules


def sector_jobs(
    tabs: DataFrame,
    residual_area: str | None = rules.RESIDUAL_AREA,
    outside: tuple[str, ...] = (rules.STATE_AREA,),
) -> DataFrame:
    """Stacked area tabs, one column per month, to ``(geography, sector, month, jobs)``.

    One area does not publish "Other Services": there it is the private services less the named ones,
    and its joint mining and construction sector counts as construction. Region rows sum all areas
    but the state; a missing number in one area makes the region's missing.
    """
    long = unpivot_like(tabs, r"^X?\d{4}-", "month", "jobs", cast="double").select(
        "geography", F.trim("`NAICS.INDUSTRY`").alias("sector"), parse_date("month", "ymd").alias("month"), "jobs"
    )
    if residual_area is not None:
        area = long.filter(F.col("geography") == residual_area)
        rest = residual_rows(
            area, "sector", ["geography", "month"], "jobs", "Private Service Providing", rules.SERVICE_SECTORS, "Other Services"
        )
        merged = replace_all("sector", "Mining, Logging, and Construction", "Construction")
        long = stack(long, rest).withColumn(
            "sector", F.when(F.col("geography") == residual_area, merged).otherwise(F.col("sector"))
        )
    return add_region(long, "geography", ["sector", "month"], ["jobs"], outside=list(outside))


def labelled(jobs: DataFrame) -> DataFrame:
    return jobs.withColumns({"year": F.year("month").cast("string"), "date": month_label("month")})


def total_jobs(jobs: DataFrame, first_year: int = 2015, outside: str = rules.STATE_AREA) -> DataFrame:
    """Total nonfarm jobs of the region next to the state's."""
    return labelled(jobs.filter(
        (F.col("sector") == "Total Nonfarm") & F.col("geography").isin("Region", outside)
        & (F.col("month") >= F.lit(f"{first_year}-01-01").cast("date"))
    ))


def latest_month_by_sector(jobs: DataFrame, first_year: int = 2018) -> DataFrame:
    """The region's sectors in the latest month of the year, for every year, in display order."""
    last = F.month(jobs.agg(F.max("month")).scalar())
    rows = jobs.filter(
        (F.col("geography") == "Region") & F.col("sector").isin(*rules.SECTORS, "Total Nonfarm")
        & (F.col("month") >= F.lit(f"{first_year}-01-01").cast("date")) & (F.month("month") == last)
    )
    return labelled(rows).withColumn("place", category_rank("sector", rules.SECTOR_ORDER))


def yearly_change(jobs: DataFrame, month: int, first_year: int, sector: str = "Total Nonfarm") -> DataFrame:
    """The region's jobs in one month of every year and the change against the year before."""
    rows = jobs.filter(
        (F.col("geography") == "Region") & (F.col("sector") == sector)
        & (F.col("month") >= F.lit(f"{first_year}-01-01").cast("date"))
    )
    return delta_same_month(rows, "jobs", ["geography", "sector"], "month", month)


def monthly_change(jobs: DataFrame, first_year: int = 2020, sector: str = "Total Nonfarm") -> DataFrame:
    rows = jobs.filter(
        (F.col("geography") == "Region") & (F.col("sector") == sector)
        & (F.col("month") >= F.lit(f"{first_year}-01-01").cast("date"))
    )
    return delta_prev(rows, "jobs", ["geography", "sector"], "month")


def lowest_month(jobs: DataFrame, year: int, sector: str = "Total Nonfarm") -> DataFrame:
    rows = jobs.filter(
        (F.col("geography") == "Region") & (F.col("sector") == sector) & (F.year("month") == year)
    )
    return at_extreme(rows, "jobs", "min")
