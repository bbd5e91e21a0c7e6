"""Parameterised dashboard views.

Every view takes a table and its parameters and returns what the plot shows. A parameter becomes a
literal in the plan, so the filter and the choice of column reach the file scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiolume.functions.dates import month_label, month_name, parse_date
from regiolume.functions.numbers import half_even
from regiolume.functions.recode import case_when, not_in_keep_null
from regiolume.functions.text import recode_chain, remove_all, title_case, wrap_text
from regiolume.operators.aggregate import strict_sum
from regiolume.operators.project import distinct_values, select_metric
from regiolume.plans import rules
from regiolume.plans.market import rents_labelled

# Spellings, and the measures a reader can choose.
INJURY_STEPS = (("Fatality", "Traffic Related Deaths"), ("Serious Injury", "Serious Injuries"))
COLLISION_MEASURES = ("injuries", "collisions", "injury_rate_per_100k", "collision_rate_per_100k")
SALES_MEASURES = ("price", "sales", "listings", "inventory")
OBSERVED_TRAVEL = "Observed VMT"
PASSENGERS = ("Subtotal - Domestic Passengers", "Subtotal - International Passengers")
FREIGHT = ("Subtotal - Domestic Air Freight", "Subtotal - International Air Freight")


# Tables cleaned once for several views ---------------------------------------------------------


def clean_collisions(table: DataFrame) -> DataFrame:
    return table.withColumns({
        "injury_type": recode_chain("injury_type", INJURY_STEPS),
        "injury_rate_per_100k": half_even("injury_rate_per_100k", 1),
        "collision_rate_per_100k": half_even("collision_rate_per_100k", 1),
    })


def clean_jobs(table: DataFrame, first_year: int = 2015, unfinished: Sequence[str] = ()) -> DataFrame:
    """Months from ``first_year`` on; months named ``unfinished`` (``May-2023``) are left out."""
    rows = table.withColumn("date", parse_date(F.col("date").cast("string"), "ymd"))
    rows = rows.filter(F.year("date") >= first_year).withColumn("year", month_label("date"))
    return rows.filter(not_in_keep_null("year", list(unfinished))) if unfinished else rows


def clean_unemployment(table: DataFrame) -> DataFrame:
    date = parse_date("date", "mdy")
    rows = table.withColumns({"geography": title_case("geography"), "date": date}).withColumn(
        "year", F.concat_ws("-", month_name("date", short=True), F.dayofmonth("date"), F.year("date"))
    )
    return rows.filter(F.col("geography").isin(*rules.COUNTIES))


# Views -----------------------------------------------------------------------------------------


def vehicles_by_type(table: DataFrame, metric: str) -> DataFrame:
    """Registered vehicles of the region by type, without totals and combustion engines."""
    rows = table.filter((F.col("county") == "Region") & (F.col("metric") == metric))
    return rows.filter(~F.col("variable").rlike("Total") & ~F.col("variable").rlike("Internal")).withColumn(
        "year", month_label("date")
    )


def new_registrations(table: DataFrame, measure: str) -> DataFrame:
    measures = [c for c in table.columns if c not in ("geography", "date", "variable")]
    rows = select_metric(table.filter(F.col("geography") == "Region"), ["date", "variable"], measure, measures)
    return rows.withColumn("year", month_label("date"))


def vehicle_makes(table: DataFrame, year: int, metric: str) -> DataFrame:
    return table.filter((F.col("metric") == metric) & (F.col("year") == year))


def vehicle_miles(table: DataFrame, variable: str) -> DataFrame:
    rows = table.filter((F.col("metric") == OBSERVED_TRAVEL) & (F.col("variable") == variable))
    return rows.select("geography", "estimate", F.col("data_year").cast("string").alias("year"))


def share_by_group(table: DataFrame, year: int, variable: str, width: int = 20, both_cases: bool = False) -> DataFrame:
    """One variable by population group, smallest share first; the suffix "alone" is left off."""
    group = remove_all("grouping", " [aA]lone" if both_cases else " alone")
    rows = table.filter((F.col("year") == year) & (F.col("variable") == variable)).withColumn("grouping", group)
    return rows.withColumn("race", wrap_text("grouping", width)).orderBy("share")


def work_from_home(table: DataFrame, year: int) -> DataFrame:
    return share_by_group(table, year, "Worked from Home")


def transit_commute(table: DataFrame, year: int) -> DataFrame:
    return share_by_group(table, year, "Transit")


def home_owners(table: DataFrame, year: int) -> DataFrame:
    return share_by_group(table, year, "Own", 25, both_cases=True)


def collisions_region(table: DataFrame, measure: str) -> DataFrame:
    rows = table.filter((F.col("geography") == "County") & (F.col("name") == "Region"))
    out = select_metric(rows, ["geography", "name", "year", "injury_type"], measure, COLLISION_MEASURES, "metric")
    return out.withColumn("data_year", F.col("year").cast("string"))


def fatality_by_group(table: DataFrame, year: int) -> DataFrame:
    rows = table.filter(
        (F.col("geography") == "Race & Ethnicity") & (F.col("injury_type") == "Traffic Related Deaths") & (F.col("year") == year)
    )
    return rows.select(
        "geography", "name", "year", "injury_type", F.col("injury_rate_per_100k").alias("fatality_rate"),
        wrap_text("name", 15).alias("race"),
    ).orderBy("fatality_rate")


def injuries_by_gender(table: DataFrame, year: int, injury_type: str) -> DataFrame:
    rows = table.filter(
        (F.col("geography") == "Gender") & (F.col("injury_type") == injury_type) & (F.col("year") == year)
    )
    return rows.select("geography", "name", "year", "injury_type", "injuries")


def transit_by_month(table: DataFrame, concept: str, first_year: int = 2019) -> DataFrame:
    rows = table.filter(
        (F.col("geography") == "Region") & (F.col("variable") == "Total Transit") & (F.col("concept") == concept)
        & (F.col("date") >= F.lit(f"{first_year}-01-01").cast("date"))
    )
    return rows.withColumns({"display_date": month_name("date", short=True), "year": F.year("date").cast("string")})


def transit_by_mode(table: DataFrame, concept: str, first_year: int = 2019) -> DataFrame:
    rows = table.filter(
        (F.col("geography") == "Region") & (F.col("concept") == concept) & (F.col("year") >= first_year)
        & (F.col("variable") != "Total Transit")
    )
    return rows.withColumn("year", F.col("year").cast("string"))


def airport_by_month(table: DataFrame, variable: str) -> DataFrame:
    rows = table.filter(F.col("variable") == variable)
    return rows.select("variable", month_name("data_day", short=True).alias("display_date"), "estimate", "year")


def _airport_by_year(table: DataFrame, variables: tuple[str, ...], name: str) -> DataFrame:
    kind = case_when([
        (F.col("variable").rlike("Domestic"), "Domestic"), (F.col("variable").rlike("International"), "International")
    ])
    sums = table.filter(F.col("variable").isin(*variables)).groupBy("year", "variable").agg(strict_sum("estimate").alias(name))
    return sums.select(F.col("year").cast("string").alias("year"), kind.alias("variable"), name)


def airport_passengers(table: DataFrame) -> DataFrame:
    return _airport_by_year(table, PASSENGERS, "passengers")


def airport_freight(table: DataFrame) -> DataFrame:
    return _airport_by_year(table, FREIGHT, "cargo")


def jobs_total(table: DataFrame, unfinished: Sequence[str] = ()) -> DataFrame:
    return clean_jobs(table, unfinished=unfinished).filter(F.col("variable") == "Total Nonfarm")


def industries(table: DataFrame, unfinished: Sequence[str] = ()) -> DataFrame:
    """The choices of the industry view."""
    rows = clean_jobs(table, unfinished=unfinished).filter((F.col("geography") == "Region") & not_in_keep_null("variable", ["Total Nonfarm"]))
    return distinct_values(rows, "variable")


def jobs_by_industry(table: DataFrame, industry: str, unfinished: Sequence[str] = ()) -> DataFrame:
    return clean_jobs(table, unfinished=unfinished).filter((F.col("geography") == "Region") & (F.col("variable") == industry))


def unemployment(table: DataFrame) -> DataFrame:
    return clean_unemployment(table)


def home_sales(table: DataFrame, measure: str) -> DataFrame:
    rows = table.withColumn("date", parse_date("period", "my")).withColumn("year", month_label("date"))
    out = select_metric(rows, ["year", "region"], measure, SALES_MEASURES, "estimate")
    return out.withColumnRenamed("region", "geography")


def rents(table: DataFrame, region: str) -> DataFrame:
    return rents_labelled(table, region)
