"""Taxable retail sales: region by quarter, cities against the same quarter of a base year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiolume.functions.dates import parse_quarter
from regiolume.functions.numbers import ratio
from regiolume.functions.recode import category_rank, null_if
from regiolume.functions.text import replace_first
from regiolume.operators.aggregate import strict_sum
from regiolume.operators.filters import drop_any_null
from regiolume.operators.joins import assert_unique, left_join
from regiolume.operators.reshape import pivot_periods
from regiolume.operators.series import forward_fill
from regiolume.plans import rules


# Rows of a file that are filled together.
BLOCK_ROWS = 100_000


def quarterly_sales(
    table: DataFrame, order: str = "pos", per: Sequence[str] | None = None, block: Column | None = None
) -> DataFrame:
    """Label rows mixed with quarter rows to ``(geography, quarter, tax_type, total)``.

    A row whose first column holds no quarter, of whatever year, names the place of the rows below it. ``order`` is the
    row's place in its file and ``block`` cuts long files into pieces for the fill. ``per`` tells files
    apart, by default the column ``file`` where there is one; a place that occurs twice is an error.
    """
    if per is None:
        per = ("file",) if "file" in table.columns else ()
    block = F.floor(F.col(order) / BLOCK_ROWS) if block is None else block
    assert_unique(table, [*per, order])
    quarter = parse_quarter("Year")
    rows = table.select(
        *per, order, F.when(quarter.isNull(), null_if("Year", " ")).alias("geography"), quarter.alias("quarter"),
        null_if("`Tax.Type`", " ").alias("tax_type"),
        null_if(F.col("`Total.Taxable`").cast("string"), " ").try_cast("double").alias("total"),
    )
    filled = forward_fill(rows, "geography", order, list(per), block)
    typed = filled.select("geography", "quarter", "tax_type", "total")
    return drop_any_null(typed)


def region_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy("quarter", "tax_type").agg(strict_sum("total").alias("total"))


def city_ratios(sales: DataFrame, cities: DataFrame, base: str, current: str, tax_type: str = "Sales") -> DataFrame:
    """Each city's quarter against the same quarter of the base year, with the city's class.

    The county suffix of a place goes before its parts are summed, spellings are mended after the
    sum. A place without the base quarter is left out; a part without the current quarter makes the
    place's current value missing.
    """
    pick = {"base": base, "current": current}
    quarters = {name: F.lit(q).cast("date") for name, q in pick.items()}
    rows = sales.filter((F.col("tax_type") == tax_type) & F.col("quarter").isin(*quarters.values()))
    parts = pivot_periods(rows, ["geography"], F.col("quarter"), F.col("total"), quarters).filter(
        F.col("base").isNotNull()
    )
    place = F.col("geography")
    for suffix in rules.TAX_COUNTY_SUFFIXES:
        place = replace_first(place, suffix, "")
    places = parts.groupBy(place.alias("geography")).agg(
        strict_sum("base").alias("base"), strict_sum("current").alias("current")
    )
    for old, new in rules.TAX_SPELLINGS:
        places = places.withColumn("geography", replace_first("geography", old, new))
    out = left_join(
        places.withColumn("ratio", ratio("current", "base")), cities.select("city_name", "class_desc"),
        {"geography": "city_name"}, defaults={"class_desc": rules.TAX_CLASS_DEFAULT},
    )
    return out.withColumn("place_in_order", category_rank("class_desc", rules.TAX_CLASS_ORDER))

