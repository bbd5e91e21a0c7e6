"""Headline numbers as one long table ``(metric, value)``.

Each group of numbers comes from one conditional aggregation. Dates are given as numbers: a year, a
month, or ``yyyymm``. A "most similar" metric has one row per tie.

The small yearly or monthly table a group of numbers needs is staged first: the facts behind it are
read once, and everything after works on a few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiolume.functions.numbers import half_even, ratio
from regiolume.operators.aggregate import metric_rows
from regiolume.operators.series import nearest_period
from regiolume.operators.setops import stack
from regiolume.plans import rules
from regiolume.session import stage


def one_row(df: DataFrame, cells: Mapping[str, Column], value: str) -> DataFrame:
    """One row whose columns are the values that pass each test."""
    return df.agg(*[F.max(F.when(test, F.col(value))).alias(name) for name, test in cells.items()])


def percent(part: Column, whole: Column, digits: int = 0) -> Column:
    return half_even(ratio(part, whole) * 100, digits)


def growth_headlines(change: DataFrame, after: int = 2010) -> DataFrame:
    """The region's change in the latest year, its largest change before, and the most similar year.

    ``change`` holds ``(place, variable, year, estimate)`` with migration, natural increase and total.
    """
    def of(variable: str) -> Column:
        return F.max(F.when(F.col("variable") == variable, F.col("estimate")))

    years = stage(change.filter(F.col("place") == "Region").groupBy("year").agg(
        of("Migration").alias("migration"), of("Natural Increase").alias("natural"), of("Total Change").alias("total")
    ), "years")
    latest = years.agg(F.max("year")).scalar()
    earlier = (F.col("year") > after) & (F.col("year") != latest)
    now = F.col("year") == latest
    one = years.agg(
        F.max("year").alias("latest_year"),
        half_even(F.max(F.when(now, F.col("migration") + F.col("natural"))), -2).alias("change"),
        F.max(F.when(now, F.col("migration"))).alias("migration"),
        F.max(F.when(earlier, F.col("total"))).alias("top"),
        F.max_by("year", F.when(earlier, F.col("total"))).alias("top_year"),
        F.max_by("migration", F.when(earlier, F.col("total"))).alias("top_migration"),
    )
    facts = metric_rows(one, {
        "latest year": F.col("latest_year"),
        "population change": F.col("change"),
        "migration share of change": percent(F.col("migration"), F.col("change")),
        "largest change": half_even("top", -2),
        "year of largest change": F.col("top_year"),
        "migration share of largest change": percent(F.col("top_migration"), F.col("top")),
    })
    past = years.filter(earlier)
    similar = nearest_period(past, "total", one.select("change").scalar())
    return facts.unionByName(
        similar.select(F.lit("most similar year").alias("metric"), F.col("year").cast("double").alias("value"))
    )


def place_headlines(
    rows: DataFrame, variable: str, first: int, last: int, cities: Sequence[str], counties: Sequence[str], main: str, prefix: str
) -> DataFrame:
    """Changes between two years of the region, counties and cities, and their shares.

    ``main`` is the county the cities lie in: city shares are of its change, county shares of the
    region's.
    """
    places = ["Region", *counties, *cities]
    cells = {}
    for i, place in enumerate(places):
        here = (F.col("place") == place) & (F.col("variable") == variable)
        cells[f"a{i}"] = here & (F.col("year") == first)
        cells[f"b{i}"] = here & (F.col("year") == last)
    one = one_row(rows.filter(F.col("place").isin(*places) & F.col("year").isin(first, last)), cells, "estimate")
    change = {p: F.col(f"b{i}") - F.col(f"a{i}") for i, p in enumerate(places)}
    start = {p: F.col(f"a{i}") for i, p in enumerate(places)}
    out = {f"{prefix} change, {p}": change[p] for p in places}
    for p in counties:
        out[f"{prefix} percent change, {p}"] = percent(change[p], start[p])
    out[f"{prefix} share of region, {main}"] = percent(change[main], change["Region"])
    if cities:
        together = change[cities[0]]
        for p in cities[1:]:
            together = together + change[p]
        out[f"{prefix} share of {main}, {cities[0]}"] = percent(change[cities[0]], change[main])
        out[f"{prefix} share of {main}, all cities"] = percent(together, change[main])
    return metric_rows(one, out)


def unit_headlines(
    units: DataFrame, first: int, previous: int, last: int,
    total: str = "Total Housing Units", part: str = "Two or More Housing Units",
) -> DataFrame:
    """New units over one and several years, and the part's share; shares are of rounded changes."""
    region = units.filter(F.col("place") == "Region")
    cells = {
        f"{kind}{year}": (F.col("variable") == variable) & (F.col("year") == year)
        for kind, variable in (("t", total), ("p", part)) for year in (first, previous, last)
    }
    one = one_row(region, cells, "estimate")

    def change(kind: str, base: int) -> Column:
        return half_even(F.col(f"{kind}{last}") - F.col(f"{kind}{base}"), -2)

    return metric_rows(one, {
        "new units, one year": change("t", previous),
        "new units, several years": change("t", first),
        "multi-family units, one year": change("p", previous),
        "multi-family units, several years": change("p", first),
        "multi-family share, one year": percent(change("p", previous), change("t", previous)),
        "multi-family share, several years": percent(change("p", first), change("t", first)),
    })


def job_headlines(
    jobs: DataFrame, base: int, low: int, last: int, sectors: Sequence[str], total: str = "Total Nonfarm",
    outside: str = rules.STATE_AREA, after: int = 2010,
) -> DataFrame:
    """Latest month against the same month of earlier years, lowest month, most similar months, sectors."""
    kept = jobs.filter(F.col("geography").isin("Region", outside) & F.col("sector").isin(total, *sectors))
    jobs = stage(kept.select("geography", "sector", "month", "jobs"), "jobs")
    latest = F.month(jobs.agg(F.max("month")).scalar())
    region, state = F.col("geography") == "Region", F.col("geography") == outside
    year, same = F.year("month"), F.month("month") == latest
    all_jobs = F.col("sector") == total
    cells = {
        f"y{y}": region & all_jobs & same & (year == y) for y in (base, low, last)
    } | {"state": state & all_jobs & same & (year == last)}
    for i, s in enumerate(sectors):
        for y in (base, low, last):
            cells[f"s{i}_{y}"] = region & (F.col("sector") == s) & same & (year == y)
    in_low = region & all_jobs & (year == low)
    one = jobs.agg(
        F.month(F.max("month")).alias("latest_month"),
        *[F.max(F.when(test, F.col("jobs"))).alias(name) for name, test in cells.items()],
        F.min(F.when(in_low, F.col("jobs"))).alias("lowest"),
        F.min_by(F.month("month"), F.when(in_low, F.col("jobs"))).alias("lowest_month"),
    )
    out = {
        "latest month": F.col("latest_month"),
        f"jobs {low} as percent of {base}": percent(F.col(f"y{low}"), F.col(f"y{base}")),
        f"jobs {last} as percent of {base}": percent(F.col(f"y{last}"), F.col(f"y{base}")),
        f"region as percent of state {last}": percent(F.col(f"y{last}"), F.col("state")),
        f"lowest jobs {low}": F.col("lowest"),
        f"lowest month {low}": F.col("lowest_month"),
    }
    for i, s in enumerate(sectors):
        a, b, c = (F.col(f"s{i}_{y}") for y in (base, low, last))
        out[f"{s}, change to {low}"] = half_even(b - a, -2)
        out[f"{s}, change to {last}"] = half_even(c - a, -2)
        out[f"{s}, percent change"] = percent(c - a, a)
    series = jobs.filter(region & all_jobs & (year > after)).select("month", "jobs")
    stamp = (F.year("month") * 100 + F.month("month")).cast("double").alias("value")
    like_low = nearest_period(series.filter(year < low), "jobs", one.select("lowest").scalar())
    like_last = nearest_period(series.filter(year < last), "jobs", one.select(f"y{last}").scalar())
    return stack(
        metric_rows(one, out),
        like_low.select(F.lit(f"month most similar to the lowest of {low}").alias("metric"), stamp),
        like_last.select(F.lit(f"month most similar to the latest of {last}").alias("metric"), stamp),
    )


def airport_headlines(weekly: DataFrame, base: int, last: int) -> DataFrame:
    """Latest and lowest airport week; weeks are told by month and day.

    ``weekly`` holds ``(year, day, passenger_screenings)`` with all years on one calendar.
    """
    seen = F.col("passenger_screenings")
    filled = stage(weekly.filter(seen.isNotNull()).select("year", "day", "passenger_screenings"), "weeks")
    latest = filled.filter(F.col("year") == str(last)).agg(F.max("day")).scalar()
    there = F.col("day") == latest
    one = filled.agg(
        *[F.max(F.when(there & (F.col("year") == str(y)), seen)).alias(f"y{y}") for y in (base, last)],
        F.max(F.when(there, F.col("day"))).alias("latest_day"),
        F.min(seen).alias("lowest"),
    )
    facts = metric_rows(one, {
        f"screenings {base}, latest week": F.col(f"y{base}"),
        f"screenings {last}, latest week": F.col(f"y{last}"),
        "percent below base": half_even(1 - ratio(f"y{last}", f"y{base}"), 2) * 100,
        "latest week, month": F.month("latest_day"),
        "latest week, day": F.dayofmonth("latest_day"),
        "lowest screenings": F.col("lowest"),
    })
    lowest = filled.filter(seen == filled.agg(F.min(seen)).scalar())
    stamp = (F.month("day") * 100 + F.dayofmonth("day")).cast("double").alias("value")
    return facts.unionByName(lowest.select(F.lit("lowest week, month and day").alias("metric"), stamp))
