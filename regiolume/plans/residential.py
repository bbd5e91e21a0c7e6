"""Residential sales: four assessor layouts to one schema, then the summaries.

Each layout function returns ``schema.REGIONAL_SALES``. Bulk transactions (same date, price and
buyer) are removed per county as the sources require; one county's layout does not name buyers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiolume.functions.numbers import parse_number, price_bin
from regiolume.functions.recode import case_when, fill_null, last_match, not_in_keep_null
from regiolume.functions.text import replace_all
from regiolume.operators.aggregate import count_filled, max_each, unique_rows
from regiolume.operators.joins import left_join
from regiolume.operators.quantile import exact_median
from regiolume.operators.setops import cut_over, stack
from regiolume.plans import rules
from regiolume.schema import REGIONAL_SALES
from regiolume.session import stage


def _with_date_parts(df: DataFrame, c: str, sep: str = "/", century: int = 0) -> DataFrame:
    parts = F.split(F.col(f"`{c}`"), sep)
    return df.withColumns({
        "month": F.get(parts, F.lit(0)).try_cast("int"), "year": F.get(parts, F.lit(2)).try_cast("int") + F.lit(century),
    })


def _in_years(df: DataFrame, years: tuple[int, int]) -> DataFrame:
    return df.filter(F.col("year").between(*years))


def _buyer(c: str) -> Column:
    return replace_all(c, " ", "_")


def _regional(df: DataFrame, parcel: Column, price: str, housing_type: Column, county: str) -> DataFrame:
    paid = fill_null(F.col(price).cast("double"), 0.0)
    cols = {
        "parcel_number": parcel, "month": F.col("month"), "year": F.col("year"), "sale_price": paid,
        "price_bin": price_bin(paid), "housing_type": housing_type, "county": F.lit(county),
    }
    return df.select(*[cols[name].cast(kind).alias(name) for name, kind in REGIONAL_SALES.items()])


def _class_type(c: str, ranges: Mapping[int, Sequence[tuple[int, int]]]) -> Column:
    """Housing type from property class ranges; a class in none of them is type 0."""
    tests = []
    for kind, spans in ranges.items():
        hit = F.lit(False)
        for low, high in spans:
            hit = hit | F.col(c).between(low, high)
        tests.append((hit, kind))
    return case_when(tests, 0)


def king_parcel(legacy: bool = False) -> list[Column]:
    """Key of a parcel: the pair of numbers; ``legacy`` adds them up, so different parcels can meet."""
    major, minor = F.col("major").try_cast("double"), F.col("minor").try_cast("double")
    return [(major + minor).alias("pin")] if legacy else [
        F.trim("major").alias("major"), F.trim("minor").alias("minor")
    ]


def king_buildings(buildings: DataFrame, legacy: bool = False) -> DataFrame:
    """Largest living units, size and zip code per parcel, in one aggregation."""
    rows = buildings
    for c in ("nbrlivingunits", "zipcode", "sqfttotliving"):
        rows = rows.filter(F.col(c).isNull() | (F.col(c).cast("string") != "0"))
    keyed = rows.select(*king_parcel(legacy), "nbrlivingunits", "sqfttotliving", "zipcode")
    keys = [c for c in keyed.columns if c in ("pin", "major", "minor")]
    return max_each(keyed, keys, ["nbrlivingunits", "sqfttotliving", "zipcode"]).withColumnsRenamed(
        {"nbrlivingunits": "units", "sqfttotliving": "sqft"}
    )


def king_sales(
    sales: DataFrame, condo_units: DataFrame, complexes: DataFrame, years: tuple[int, int] = rules.SALE_YEARS, legacy: bool = False
) -> DataFrame:
    """County with principal uses, condominium units and construction classes.

    A complex listed twice repeats its sales, as in the source; guard it with ``assert_unique``.
    """
    kept = sales.filter(
        (F.col("saleprice").isNull() | (F.col("saleprice") != 0))
        & (F.col("propertytype").isNull() | (F.col("propertytype") != 0))
        & F.col("principaluse").isin(*rules.KING_USES)
    )
    dated = _in_years(_with_date_parts(kept, "documentdate"), years)
    single = unique_rows(dated, ["documentdate", "saleprice", _buyer("buyername")])
    single = single.filter(fill_null("propertytype", 0) <= rules.KING_LAST_PROPERTY_TYPE)
    pins = king_parcel(legacy)
    names = ["pin"] if legacy else ["major", "minor"]
    condos = condo_units.filter((F.col("unittype") < rules.CONDO_TYPES_BELOW) & (F.col("unittype") != 0))
    condos = condos.select(*pins, F.col("unittype").alias("condo_type")).groupBy(*names).agg(
        F.max("condo_type").alias("condo_type")
    )
    single = single.withColumns(dict(zip(names, pins)))
    rows = left_join(single, condos, names, defaults={"condo_type": 0})
    dense = (F.col("constrclass") <= rules.HIGH_DENSITY_CLASS).cast("int")
    density = complexes.select(F.col("major").try_cast("double").alias("m"), fill_null(dense, 0).alias("high_density"))
    rows = left_join(
        rows.withColumn("major_number", F.col("major").try_cast("double")), density, {"major_number": "m"},
        defaults={"high_density": 0},
    )
    use, condo = F.col("principaluse"), F.col("condo_type")
    ruled = last_match([
        (use == 8, 1), (use < 6, 4), ((use == 6) & (condo > 0), 4), (condo.isin(2, 4), 4), (condo.isin(1, 3), 5),
        (F.col("high_density") == 1, 6),
    ], 0)
    kind = F.when(ruled == 0, 2).otherwise(ruled)
    parcel = F.col("pin") if legacy else F.concat_ws("-", "major", "minor")
    return _regional(rows, parcel, "saleprice", kind, "king")


def kitsap_sales(
    early: DataFrame, late: DataFrame, parcels: DataFrame, years: tuple[int, int] = rules.SALE_YEARS, cut: int = rules.KITSAP_CUT_YEAR
) -> DataFrame:
    """County with two overlapping deliveries and a property class per parcel; no buyer is named."""
    a = _with_date_parts(early.select(
        F.col("acct_no").alias("parcel"), F.col("sale_dt").alias("sold"), F.col("price").cast("double").alias("price")
    ), "sold")
    b = _with_date_parts(late.select(
        F.col("`tax parcel no.`").alias("parcel"), F.col("`sale dt`").alias("sold"),
        parse_number("price", "double").alias("price"),
    ), "sold")
    rows = _in_years(cut_over(a, b, F.col("year") < cut, F.col("year").between(*years)), years)
    classes = parcels.select(F.col("acct_no").alias("parcel"), "property_class")
    rows = left_join(rows, classes, "parcel", defaults={"property_class": 0})
    rows = rows.filter(F.col("property_class").between(*rules.KITSAP_CLASSES))
    return _regional(rows, F.col("parcel"), "price", _class_type("property_class", rules.KITSAP_TYPES), "kitsap")


def pierce_housing(improvements: DataFrame) -> DataFrame:
    """Housing type per parcel: the highest type among its buildings; unknown types are left out."""
    kind = case_when([(F.col("occupancy_description").isin(*names), k) for k, names in rules.PIERCE_TYPES.items()])
    rows = improvements.filter(not_in_keep_null("property_type", rules.PIERCE_EXCLUDED)).select(
        "parcel_number", kind.alias("housing_type")
    )
    return rows.filter(F.col("housing_type").isNotNull()).groupBy("parcel_number").agg(
        F.max("housing_type").alias("housing_type")
    )


def pierce_sales(sales: DataFrame, improvements: DataFrame, years: tuple[int, int] = rules.SALE_YEARS) -> DataFrame:
    """County with headerless extracts; a sale without a known building is left out."""
    dated = _in_years(_with_date_parts(
        sales.select("parcel_number", "sale_date", F.col("sale_price").cast("double").alias("sale_price"), "grantee"), "sale_date"
    ), years)
    rows = left_join(dated, pierce_housing(improvements), "parcel_number").filter(F.col("housing_type").isNotNull())
    single = unique_rows(rows, ["sale_date", "sale_price", _buyer("grantee")])
    return _regional(single, F.col("parcel_number"), "sale_price", F.col("housing_type"), "pierce")


def snohomish_sales(sales: DataFrame, years: tuple[int, int] = rules.SALE_YEARS) -> DataFrame:
    """County with two-digit years and prices with separators; rows without date, price or street are dropped."""
    kept = sales.filter(F.col("prop_class").between(*rules.SNOHOMISH_CLASSES)).na.drop(
        "any", subset=["sale_date", "sale_price", "propertystreet"]
    )
    dated = _in_years(_with_date_parts(kept, "sale_date", "-", 2000), years)
    priced = dated.withColumn("paid", parse_number("sale_price", "double"))
    single = unique_rows(priced, ["sale_date", "paid", _buyer("ownername1")])
    return _regional(single, F.col("parcel_id"), "paid", _class_type("prop_class", rules.SNOHOMISH_TYPES), "snohomish")


def regional_sales(*counties: DataFrame) -> DataFrame:
    return stack(*counties)


def transactions_by_type(sales: DataFrame) -> DataFrame:
    return count_filled(sales, ["year", "housing_type", "county"], "sale_price", "transactions")


def transactions_by_type_and_bin(sales: DataFrame) -> DataFrame:
    return count_filled(sales, ["year", "housing_type", "price_bin", "county"], "sale_price", "transactions")


def median_price_by_type(sales: DataFrame) -> DataFrame:
    return exact_median(sales, ["year", "housing_type", "county"], "sale_price", "median-sales-price")


def sales_report(sales: DataFrame) -> dict[str, DataFrame]:
    """Transactions and the three summaries, ready for ``write_report``. The transactions are staged, so that the counties are
    read and joined once."""
    sales = stage(sales, "sales")
    return {
        "total_residential_sales_transactions_region": sales,
        "summarized_transactions_by_year_type_region": transactions_by_type(sales),
        "summarized_transactions_by_year_type_price_region": transactions_by_type_and_bin(sales),
        "median_price_by_type_region": median_price_by_type(sales),
    }
