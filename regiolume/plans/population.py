"""Population by place and year, components of change, housing units, growth by place class."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiolume.functions.dates import anchor_date
from regiolume.functions.numbers import half_even, sentinel_number
from regiolume.functions.recode import case_when, category_rank, fill_null, not_in_keep_null
from regiolume.functions.text import (
    recode_chain,
    replace_all,
    replace_first,
    strip_breaks,
    strip_part_suffix,
    sub_text,
)
from regiolume.operators.aggregate import strict_sum
from regiolume.operators.filters import exclude_pairs
from regiolume.operators.joins import left_join, lookup
from regiolume.operators.project import names_like
from regiolume.operators.reshape import split_into, unpivot_like
from regiolume.operators.series import class_growth, delta_prev, delta_target
from regiolume.operators.setops import stack
from regiolume.operators.topk import top_n, top_n_per_group
from regiolume.operators.totals import add_region_levels, merge_parts
from regiolume.plans import rules
from regiolume.session import stage

STATE = "State"


def population(
    table: DataFrame,
    counties: Sequence[str] = (*rules.COUNTIES, STATE),
    labels: Mapping[Any, str] = rules.REGION_LEVELS,
) -> DataFrame:
    """One column per year to ``(level, place, year, variable, estimate)`` with region rows per level.

    Parts of a place in several counties are summed; numbers are text with ``.`` for a missing one.
    Levels: 1 county, 2 unincorporated, 3 incorporated, 4 place; only 1 to 3 give region rows.
    """
    kept = table.filter(F.col("County").isin(*counties))
    kept = kept.select("Filter", "Jurisdiction", *[F.col(f"`{c}`") for c in names_like(kept, "Population")])
    long = unpivot_like(kept, "Population", "year", "estimate", "string").select(
        F.col("Filter").try_cast("int").alias("level"), F.col("Jurisdiction").alias("place"),
        replace_first("year", ".Population.*", "").try_cast("int").alias("year"),
        sentinel_number("estimate").alias("estimate"),
    )
    places = merge_parts(long, "place", ["level", "year"], ["estimate"])
    return add_region_levels(places, "level", "place", ["year"], ["estimate"], labels).withColumn(
        "variable", F.lit("Total Population")
    )


def change_component(table: DataFrame, component: str, variable: str, counties: Sequence[str] = (*rules.COUNTIES, STATE)) -> DataFrame:
    """One component of change: columns ``<component>.<from>-<to>`` to one row per place and end year.

    Places are level 4, the region (the counties without the state) is level 5.
    """
    kept = table.filter(F.col("County").isin(*counties))
    kept = kept.select("County", "Jurisdiction", *[F.col(f"`{c}`") for c in names_like(kept, component.replace(".", r"\."))])
    long = unpivot_like(kept, component.replace(".", r"\."), "span", "estimate", "string")
    spans = split_into(long, "span", ["from", "to"], "-").select(
        F.col("County").alias("county"), strip_part_suffix("Jurisdiction").alias("place"),
        replace_first("to", "20211", "2021").try_cast("int").alias("year"),
        F.col("estimate").try_cast("double").alias("estimate"),
    )
    region = spans.filter(F.col("county") != STATE).groupBy("year").agg(strict_sum("estimate").alias("estimate")).select(
        F.lit(5).alias("level"), F.lit("Region").alias("place"), "year", "estimate"
    )
    places = spans.select(F.lit(4).alias("level"), "place", "year", "estimate")
    return stack(places, region).withColumn("variable", F.lit(variable))


# Component name in the column heads -> variable.
COMPONENTS = {
    "Natural.Increase": "Natural Increase",
    "Residual.Net.Migration": "Migration",
    "Annual.Change.in.Total.Population": "Total Change",
}


def components_of_change(tables: Mapping[str, DataFrame], counties: Sequence[str] = (*rules.COUNTIES, STATE)) -> DataFrame:
    return stack(*[change_component(df, c, COMPONENTS[c], counties) for c, df in tables.items()])


def region_components(change: DataFrame, first_year: int) -> DataFrame:
    """Natural increase and migration of the region, each year anchored at 1 April."""
    rows = change.filter(
        (F.col("place") == "Region") & (F.col("variable") != "Total Change") & (F.col("year") >= first_year)
    )
    return rows.select(anchor_date("year").alias("day"), "place", "variable", "estimate")


def housing_units(table: DataFrame, counties: Sequence[str] = rules.COUNTIES) -> DataFrame:
    """Housing units by place, type and year; missing numbers count as zero; the region is level 5.

    The region is the sum of the counties alone: adding the other levels would count places twice.
    """
    kept = table.filter(F.col("County").isin(*counties))
    heads = names_like(kept, r"\.Housing\.Units")
    kept = kept.select("Filter", "Jurisdiction", *[F.col(f"`{c}`") for c in heads])
    long = unpivot_like(kept, r"\.Housing\.Units", "head", "estimate", "string")
    cut = replace_first("head", r"\.(?:Census\.Count|Postcensal\.Estimate|Census-Based\.Estimate)\.of\.", "-")
    parts = split_into(long.withColumn("head", cut), "head", ["year", "variable"], "-")
    rows = parts.select(
        F.col("Filter").try_cast("int").alias("level"), strip_part_suffix("Jurisdiction").alias("place"),
        F.col("year").try_cast("int").alias("year"), replace_all("variable", r"\.", " ").alias("variable"),
        fill_null(F.col("estimate").try_cast("double"), 0.0).alias("estimate"),
    )
    places = rows.groupBy("level", "place", "year", "variable").agg(F.sum("estimate").alias("estimate"))
    region = places.filter(F.col("level") == 1).groupBy("year", "variable").agg(F.sum("estimate").alias("estimate"))
    return stack(places, region.withColumns({"level": F.lit(5), "place": F.lit("Region")}))


# Housing variable -> type, in display order.
UNIT_TYPES = {
    "One Unit Housing Units": "Single-Family",
    "Two or More Housing Units": "Multi-Family",
    "Mobile Home and Special Housing Units": "Mobile-Home",
}


def housing_change(units: DataFrame, first_year: int = 2010) -> DataFrame:
    """The region's units per type with the change against the year before; the first year is dropped."""
    kind = case_when([(F.col("variable") == k, v) for k, v in UNIT_TYPES.items()])
    rows = units.filter(
        (F.col("place") == "Region") & F.col("variable").isin(*UNIT_TYPES) & (F.col("year") >= first_year)
    ).select(kind.alias("unit_type"), "year", "estimate")
    changed = delta_prev(rows, "estimate", ["unit_type"], "year").filter(F.col("year") > first_year)
    return changed.withColumn("place_in_order", category_rank("unit_type", list(UNIT_TYPES.values())))


def _postcensal(table: DataFrame, heads: str, counties: Sequence[str]) -> DataFrame:
    kept = table.filter(F.col("County").isin(*counties))
    kept = kept.select("Filter", "County", "Jurisdiction", *[F.col(f"`{c}`") for c in names_like(kept, heads)])
    long = unpivot_like(kept, heads, "head", "estimate", "string").filter(F.col("estimate") != ".")
    return long.select(
        F.col("Filter").try_cast("int").alias("level"), F.col("County").alias("county"),
        F.col("Jurisdiction").alias("place"), strip_breaks("head").alias("head"),
        F.col("estimate").try_cast("double").alias("estimate"),
    ).withColumn("year", sub_text("head", 1, 4).try_cast("int"))


def _with_levels(rows: DataFrame) -> DataFrame:
    """Rows as they are plus region rows per level, labelled as published estimates."""
    low = rows.filter(F.col("level") <= 3)
    label = case_when([(F.col("level") == k, v) for k, v in rules.REGION_LEVELS_SHORT.items() if k > 1], "Region")
    region = low.groupBy("level", "variable", "year").agg(strict_sum("estimate").alias("estimate")).withColumns(
        {"county": F.lit("Region"), "place": label}
    )
    return stack(rows, region).withColumn("data_type", F.lit("Postcensal Estimates"))


def postcensal_population(table: DataFrame, counties: Sequence[str] = rules.COUNTIES) -> DataFrame:
    """Yearly population estimates since 1960; full-count years keep the count, not the estimate."""
    named = table.select(*[F.col(f"`{c}`") for c in table.columns if "." not in c and c != "Line"])
    rows = _postcensal(named, "Population", counties)
    doubled = [f"{y} Postcensal Estimate of Total Population" for y in rules.CENSUS_YEARS]
    rows = rows.filter(not_in_keep_null("head", doubled)).withColumn("variable", sub_text("head", 6)).drop("head")
    return _with_levels(rows).withColumn("variable", F.lit("Population"))


def postcensal_housing(table: DataFrame, counties: Sequence[str] = rules.COUNTIES) -> DataFrame:
    """Yearly housing estimates by type."""
    rows = _postcensal(table, "Housing Units", counties)
    kind = case_when([
        (F.col("head").contains("Mobile Home"), "Mobile Home Units"),
        (F.col("head").contains("One Unit Housing Units"), "Single-Family Units"),
        (F.col("head").contains("Two or More Housing Units"), "Multi-Family Units"),
        (F.col("head").contains("Total Housing Units"), "Total Housing Units"),
    ])
    return _with_levels(rows.withColumn("variable", kind).drop("head"))


# Growth by place -------------------------------------------------------------------------------


def place_classes(cities: DataFrame) -> DataFrame:
    """City attribute table to one row per city, county label and class.

    Cities that lie in two counties get the joint label, so their rows fall together.
    """
    label = F.col("cnty_name")
    for place, pair in rules.TWO_COUNTY_PLACES.items():
        label = F.when(F.col("city_name") == place, pair).otherwise(label)
    name = recode_chain("city_name", rules.PLACE_SPELLINGS)
    return cities.select(label.alias("county"), "city_name", "class_desc").distinct().select(
        name.alias("city"), "county", "class_desc"
    )


def jurisdictions(table: DataFrame) -> DataFrame:
    """Jurisdiction dimension with long class names, county names and the airport flag."""
    name = recode_chain("juris_name", (("Seatac", "SeaTac"), ("Beau Arts Village", "Beaux Arts Village")))
    rows = table.select(name.alias("place"), "regional_geography", "county_fips").distinct()
    rows = rows.withColumn("regional_geography", recode_chain("regional_geography", rules.PLACE_CLASS_NAMES))
    rows = lookup(rows, {p: "Yes" for p in rules.AIRPORT_PLACES}, "place", "airport_affected", default="No")
    rows = lookup(rows, rules.COUNTY_BY_FIPS, "county_fips", "county_name")
    rows = exclude_pairs(rows, "place", "county_fips", rules.SECOND_COUNTY_PAIRS)
    return rows.filter((F.col("place") != "Silverdale") & ~F.col("place").rlike("Uninc.")).drop("county_fips")


def place_growth(people: DataFrame, dims: DataFrame, target: int) -> DataFrame:
    """Population with the target year's change and the place's class and county."""
    rows = people.select("level", "place", "year", "variable", "estimate")
    changed = delta_target(rows, "estimate", ["level", "place", "variable"], "year", target)
    return left_join(changed, dims, "place")


def growth_by_class(growth: DataFrame, target: int) -> DataFrame:
    """Change per place class in display order, exact and as the sum of rounded changes."""
    rows = growth.filter((F.col("year") == target) & F.col("regional_geography").isin(*rules.PLACE_CLASS_ORDER))
    sums = rows.groupBy("regional_geography").agg(
        F.sum("delta").alias("delta"), F.sum(half_even("delta", -1)).alias("delta_rounded")
    )
    return sums.withColumn("place_in_order", category_rank("regional_geography", rules.PLACE_CLASS_ORDER))


def fastest_places(growth: DataFrame, target: int, n: int = 10, level: int = 4) -> DataFrame:
    rows = growth.filter((F.col("year") == target) & (F.col("level") == level))
    return top_n(rows, "delta", n, ["place"])


def fastest_places_by_county(growth: DataFrame, target: int, n: int = 10, level: int = 4) -> DataFrame:
    rows = growth.filter((F.col("year") == target) & (F.col("level") == level) & F.col("county_name").isNotNull())
    return top_n_per_group(rows, ["county_name"], "delta", n, ["place"])


def counts_by_county(top: DataFrame) -> DataFrame:
    """How many of the fastest places lie in each county."""
    return top.groupBy("county_name").agg(F.count(F.lit(1)).alias("places"))


def place_years(rows: DataFrame, variable: str, places: Sequence[str], years: Sequence[int]) -> DataFrame:
    """Chosen places and years of one variable, with the places in the order they are named."""
    kept = rows.filter(
        (F.col("variable") == variable) & F.col("place").isin(*places) & F.col("year").isin(*years)
    )
    return kept.withColumns({"year": F.col("year").cast("string"), "place_in_order": category_rank("place", places)})


def place_table(growth: DataFrame, first: int, last: int, level: int = 4) -> DataFrame:
    """Two years side by side per place with the change, each rounded to ten."""
    rows = growth.filter((F.col("level") == level) & F.col("year").isin(first, last))
    old, new = F.col("year") == first, F.col("year") == last
    wide = rows.groupBy("place", "county_name").agg(
        F.max(F.when(old, F.col("estimate"))).alias("first"), F.max(F.when(new, F.col("estimate"))).alias("last"),
        F.max(F.when(new, F.col("delta"))).alias("delta"),
    )
    return wide.filter(F.col("first").isNotNull()).select(
        "place", "county_name", *[half_even(c, -1).alias(c) for c in ("first", "last", "delta")]
    )


def growth_report(growth: DataFrame, target: int) -> dict[str, DataFrame]:
    """The nine tables of the population report, ready for ``write_report``; their common input is staged once."""
    growth = stage(growth, "growth")
    year = growth.filter(F.col("year") == target)
    counties = fastest_places_by_county(growth, target).drop("level")
    out = {
        "county-growth": year.filter(F.col("level") == 1).select("place", "year", "variable", "estimate", "delta"),
        "incorporated-growth": year.filter(
            F.col("place").isin(rules.REGION_LEVELS_SHORT[2], rules.REGION_LEVELS_SHORT[3])
        ).select("place", "year", "variable", "estimate", "delta"),
        "regional-geography-growth": growth_by_class(growth, target).withColumns(
            {"year": F.lit(target), "variable": F.lit("Total Population")}
        ),
        "region-fastest-growing": fastest_places(growth, target).drop("level"),
    }
    for county in rules.COUNTY_LEVELS[:-1]:
        key = county.split()[0].lower() + "-fastest-growing"
        out[key] = counties.filter(F.col("county_name") == county)
    out["city-data"] = place_table(growth, target - 1, target)
    return out


def class_change(rows: DataFrame, classes: DataFrame, variable: str, first: int, last: int) -> DataFrame:
    """Change per place class between two years; region rows are left out, unincorporated ones are a class."""
    joined = left_join(rows.filter(F.col("variable") == variable), classes, {"place": "city"})
    cls = class_of_place("place", "class_desc")
    kept = joined.withColumn("class_desc", cls).filter((F.col("class_desc") != "Region") & (F.col("level") < 100))
    out = class_growth(kept, "class_desc", F.col("year"), F.col("estimate"), first, last)
    return out.withColumn("place_in_order", category_rank("class_desc", rules.PLACE_CLASSES))


def class_of_place(place: str, cls: str) -> Column:
    """A text test on the place decides first; a missing place keeps the class missing."""
    p = F.col(place)
    return case_when([
        (p.contains("Region"), "Region"), (p.contains("Unincorporated"), "Unincorporated"), (p.isNotNull(), F.col(cls)),
    ])

