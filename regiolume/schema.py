"""Schemas: the long indicator form and the source layouts the jobs accept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiolume.sources.layouts import Layout

# One row per geography, variable and period; the form nearly every job ends in.
INDICATOR = "geography STRING, variable STRING, period DATE, estimate DOUBLE"


def indicator(df: DataFrame, geography: str, variable: str, period: str, estimate: str) -> DataFrame:
    """Bring a tidy table into the indicator schema."""
    return df.select(
        F.col(geography).cast("string").alias("geography"),
        F.col(variable).cast("string").alias("variable"),
        F.col(period).cast("date").alias("period"),
        F.col(estimate).cast("double").alias("estimate"),
    )


# Bundled dashboard tables.
SHARE_TABLE = (
    "year INT, geography STRING, grouping STRING, variable STRING, estimate DOUBLE, "
    "count_moe DOUBLE, share DOUBLE, share_moe DOUBLE"
)
VEHICLE_MAKES = "year INT, variable STRING, metric STRING, estimate INT, share DOUBLE"
HOME_SALES = "region STRING, period STRING, price INT, sales INT, listings INT, inventory INT"

# Assessor extracts, for ``read_named``: the columns the jobs use, out of many more in the files. Keys
# stay text so that leading zeros survive.
KING_SALES = {
    "major": "string", "minor": "string", "documentdate": "string", "saleprice": "double",
    "buyername": "string", "propertytype": "int", "principaluse": "int",
}
KING_BUILDINGS = {
    "major": "string", "minor": "string", "nbrlivingunits": "int", "sqfttotliving": "int",
    "zipcode": "string",
}
KING_CONDO_UNITS = {"major": "string", "minor": "string", "unittype": "int"}
KING_CONDO_COMPLEXES = {"major": "string", "constrclass": "int"}
KITSAP_SALES_EARLY = {"acct_no": "string", "sale_dt": "string", "price": "double"}
KITSAP_SALES_LATE = {"tax parcel no.": "string", "sale dt": "string", "price": "string"}
KITSAP_PARCELS = {"acct_no": "string", "property_class": "int"}
SNOHOMISH_SALES = {
    "parcel_id": "string", "prop_class": "int", "propertystreet": "string", "sale_date": "string",
    "sale_price": "string", "ownername1": "string",
}

# Column order of the headerless pipe-delimited extracts.
PIERCE_SALES_COLUMNS = (
    "etn", "parcel_count", "parcel_number", "sale_date", "sale_price", "deed_type", "grantor",
    "grantee", "valid", "confirmed", "exclude", "improved", "appraisal_account",
)
PIERCE_IMPROVEMENT_COLUMNS = (
    "parcel_number", "building_id", "property_type", "neighborhood", "neighborhood_ext", "sqft",
    "net_sqft", "percent_complete", "condition", "quality", "occupancy_code",
    "occupancy_description", "mobile_home_number", "mobile_home_length", "mobile_home_make",
    "attic_sf", "basement_sf", "finished_basement", "carport_sf", "balcony_sf", "porch_sf",
    "attached_garage", "detached_garage", "fireplaces", "basement_garage_door",
)

# How the deliveries are written.
ASSESSOR_LAYOUTS = {
    "king_sales": Layout(KING_SALES, encoding="ISO-8859-1", keys=("major", "minor")),
    "king_buildings": Layout(KING_BUILDINGS, keys=("major", "minor")),
    "king_condo_units": Layout(KING_CONDO_UNITS, keys=("major", "minor")),
    "king_condo_complexes": Layout(KING_CONDO_COMPLEXES, keys=("major",)),
    "kitsap_sales_early": Layout(KITSAP_SALES_EARLY, sep="\t", keys=("acct_no",)),
    "kitsap_sales_late": Layout(KITSAP_SALES_LATE, keys=("tax parcel no.",)),
    "kitsap_parcels": Layout(KITSAP_PARCELS, sep="\t", keys=("acct_no",)),
    "pierce_sales": Layout(
        {"parcel_number": "string", "sale_date": "string", "sale_price": "double", "grantee": "string"}, sep="|",
        encoding="ISO-8859-1", order=PIERCE_SALES_COLUMNS, keys=("parcel_number",),
    ),
    "pierce_improvements": Layout(
        {"parcel_number": "string", "property_type": "string", "occupancy_description": "string"}, sep="|",
        encoding="ISO-8859-1", order=PIERCE_IMPROVEMENT_COLUMNS, keys=("parcel_number",),
    ),
    "snohomish_sales": Layout(SNOHOMISH_SALES, keys=("parcel_id",)),
}

# One schema for the four assessor layouts.
REGIONAL_SALES = {
    "parcel_number": "string",
    "month": "int",
    "year": "int",
    "sale_price": "double",
    "price_bin": "int",
    "housing_type": "int",
    "county": "string",
}
