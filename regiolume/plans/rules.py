"""Names, codes and lists of the published sources the jobs read."""

from __future__ import annotations

from regiolume.operators.series import Event

COUNTIES = ("King", "Kitsap", "Pierce", "Snohomish")
COUNTY_LEVELS = ("King County", "Kitsap County", "Pierce County", "Snohomish County", "Region")
COUNTY_BY_FIPS = {
    "033": "King County",
    "035": "Kitsap County",
    "053": "Pierce County",
    "061": "Snohomish County",
}

# Places that lie in two counties, and the county pair they are shown under.
TWO_COUNTY_PLACES = {
    "Auburn": "King & Pierce",
    "Bothell": "King & Snohomish",
    "Pacific": "King & Pierce",
    "Enumclaw": "King & Pierce",
    "Milton": "King & Pierce",
}
# (place, fips) pairs dropped so that each of those places keeps one county.
SECOND_COUNTY_PAIRS = (
    ("Auburn", "053"),
    ("Bothell", "061"),
    ("Enumclaw", "053"),
    ("Milton", "033"),
    ("Pacific", "053"),
)
PLACE_SPELLINGS = (("Beaux Arts", "Beaux Arts Village"), ("Sea Tac", "SeaTac"))
PLACE_CLASSES = ("Metro", "Core", "HCT", "CitiesTowns", "Unincorporated")
PLACE_CLASS_NAMES = (
    ("HCT", "High Capacity Transit Community"),
    ("Metro", "Metropolitan Cities"),
    ("Core", "Core Cities"),
    ("CitiesTowns", "Cities & Towns"),
)
PLACE_CLASS_ORDER = (
    "Metropolitan Cities", "Core Cities", "High Capacity Transit Community", "Cities & Towns",
)
AIRPORT_PLACES = (
    "Auburn", "Burien", "Covington", "Des Moines", "Federal Way", "Kenmore", "Kent",
    "Lake Forest Park", "Normandy Park", "Renton", "SeaTac", "Seattle", "Skykomish", "Tukwila",
    "Bremerton", "Eatonville", "Gig Harbor", "Lakewood", "Steilacoom", "Tacoma",
    "University Place", "Arlington", "Darrington", "Everett", "Marysville", "Monroe", "Mukilteo",
    "Snohomish", "Sultan",
)

REGION_LEVELS = {
    1: "Region",
    2: "Unincorporated Region Total",
    3: "Incorporated Region Total",
}
REGION_LEVELS_SHORT = {1: "Region", 2: "Unincorporated Region", 3: "Incorporated Region"}
# Years of a full count, published as well under the postcensal name.
CENSUS_YEARS = (1970, 1980, 1990, 2000, 2010, 2020)

CONGESTION_BANDS = ((0.25, "Severe"), (0.50, "Heavy"), (0.75, "Moderate"))
CONGESTION_ABOVE = "Minimal"
HEAVY_RATIO = 0.50

STATE_AREA = "Washington State"
RESIDUAL_AREA = "Bremerton MSA"
GOODS_SECTORS = ("Mining and Logging", "Construction", "Manufacturing")
SERVICE_SECTORS = (
    "Trade, Transportation, and Utilities", "Information", "Financial Activities",
    "Professional and Business Services", "Educational and Health Services",
    "Leisure and Hospitality", "Other Services",
)
GOVERNMENT_SECTORS = ("Government",)
SECTORS = GOODS_SECTORS + SERVICE_SECTORS + GOVERNMENT_SECTORS
SECTOR_ORDER = (
    "Manufacturing", "Construction", "Mining and Logging", "Leisure and Hospitality",
    "Trade, Transportation, and Utilities", "Other Services", "Financial Activities", "Information",
    "Professional and Business Services", "Government", "Educational and Health Services",
    "Total Nonfarm",
)

EDUCATION_CLASSES = {
    "Did not finish high school": "Less than high school",
    "High School Diploma, including GED": "High school or equivalent, no college",
    "Associate's Degree": "Some college or Associate degree",
    "Some College": "Some college or Associate degree",
    "Bachelor's Degree": "Bachelor's degree or advanced degree",
    "Master's Degree": "Bachelor's degree or advanced degree",
    "PhD": "Bachelor's degree or advanced degree",
    "Post-Baccalaureate Degree": "Bachelor's degree or advanced degree",
    "No Schooling": "Educational attainment not available (workers aged 24 or younger)",
    "Unknown": "Educational attainment not available (workers aged 24 or younger)",
}
# Short classes, reached from the claim labels and from the workforce labels.
EDUCATION_CLASSES_SHORT = {
    "Did not finish high school": "Less than high school",
    "High School Diploma, including GED": "High School",
    "Associate's Degree": "Some College",
    "Some College": "Some College",
    "Bachelor's Degree": "College degree",
    "Master's Degree": "College degree",
    "PhD": "College degree",
    "Post-Baccalaureate Degree": "College degree",
    "No Schooling": "Under age 24",
    "Unknown": "Under age 24",
    "Less than high school": "Less than high school",
    "High school or equivalent, no college": "High School",
    "Some college or Associate degree": "Some College",
    "Bachelor's degree or advanced degree": "College degree",
    "Educational attainment not available (workers aged 24 or younger)": "Under age 24",
    "Total": "Total",
}
AGE_MERGE = {"18-24": ("19-21", "22-24")}
AGE_OPEN_END = ("65-99", "65+")
AGE_LEVELS = ("18-24", "25-34", "35-44", "45-54", "55-64", "65+", "Total")
WORKFORCE_QUARTER = "2020-01-01"

CLAIM_RACE_ROWS = (7, 17)
CLAIM_GENDER_ROWS = (1, 4)
CLAIM_RACE_DROPPED = ("Not Latino/Hispanic:", "Not Disclosed")
CLAIM_TITLE = ", All Unduplicated Claimants"
RACE_STEPS = (
    ("African American", "Black or African American Alone"),
    ("American Indian", "American Indian or Alaska Native Alone"),
    ("Asian", "Asian Alone"),
    ("Caucasian", "White Alone"),
    ("Latino/Hispanic of any race", "Hispanic or Latino"),
    ("Pacific Islander", "Native Hawaiian or Other Pacific Islander Alone"),
    ("Two or More Races", "Two or More Race Groups"),
)
TITLE_STEPS = (("Alone", ""), ("Latino", "Latinx"))
GENDER_STEPS = (("Nonbinary/Other", "Nonbinary"),)
INITIAL_CLAIM_ROWS = {"Gender": (1, 3), "Race": (3, 9), "Age": (2, 9), "Education": (2, 11)}
INITIAL_CLAIM_DROPPED = {
    "Gender": ("Total, All Unduplicated Claimants",),
    "Race": ("Total, All Unduplicated Claimants",),
    "Age": ("<18", "<24"),
    "Education": (),
}

WEEKLY_CLAIM_FIRST_LINE = 6
WEEKLY_CLAIM_SERIES = ("Initial Claims", "Weekly Change", "4 Week Average")

TRANSIT_REPORTERS = ("1", "3", "5", "20", "23", "29", "35", "40", "54")
TRANSIT_DROPPED_MODE = "DR"
TRANSIT_MODES = {
    "Bus": ("CB", "MB", "TB"),
    "Ferry": ("FB",),
    "Light Rail, Streetcar & Monorail": ("LR", "SR", "MG", "MO"),
    "Commuter Rail": ("CR",),
}
TRANSIT_AGENCY_STEPS = (
    ("Snohomish County Public Transportation Benefit Area Corporation", "Community Transit"),
    ("Central Puget Sound Regional Transit Authority", "Sound Transit"),
    ("King County Department of Metro Transit", "King County Metro"),
    ("Pierce County Transportation Benefit Area Authority", "Pierce Transit"),
    ("City of Everett", "Everett Transit"),
    ("King County Ferry District", "King County Metro"),
)
TRANSIT_AGENCY_ORDER = (
    "Everett Transit", "Kitsap Transit", "City of Seattle", "Pierce Transit", "Community Transit",
    "Sound Transit", "King County Metro", "Washington State Ferries",
)

HIGHWAY_COLUMNS = (
    "Highway", "County", "Location", "Date", "Previous_Date", "Measure", "Day_of_Week",
    "Current_Volume", "Baseline_Volume",
)
TRUCK_COLUMNS = (
    "Highway", "County", "Location", "Date", "Previous_Date", "Note", "Day_of_Week", "Ratio",
)
FERRY_COLUMNS = ("Date", "Previous_Date", "Route", "Measure", "Old", "Ratio")
CORRIDORS = {
    "I-5 and I-405": ("I-5", "I-405"),
    "Cross-lake": ("I-90", "SR 520"),
    "Other state routes": ("SR 167", "SR 410", "SR 512"),
}
TRUCK_CORRIDORS = CORRIDORS | {"Other state routes": ("SR 16", "SR 167", "SR 410", "SR 512")}
FERRY_ROUTES = (
    "Edmonds -  Kingston", "Fauntleroy - Vashon - Southworth", "Mukilteo - Clinton",
    "Point Defiance - Tahlequah", "Port Townsend - Coupeville", "Seattle - Bainbridge Island",
    "Seattle - Bremerton",
)
FERRY_BASE, FERRY_CURRENT, FERRY_CHANGE = (
    "Baseline year  Ridership", "Current  Ridership", "Percentage Change",
)

TAX_COUNTY_SUFFIXES = ("/king", "/pierce", "/snohomish")
TAX_SPELLINGS = (
    (" City", ""),
    ("Beaux Arts Village", "Beaux Arts"),
    ("Du Pont", "DuPont"),
    ("Seatac", "Sea Tac"),
)
TAX_CLASS_DEFAULT = "Unincorporated County"
TAX_CLASS_ORDER = ("Metro", "Core", "HCT", "CitiesTowns", "Unincorporated County")

FORECAST_THOUSANDS = (
    "Employment (thous.)", "Goods producing", "Natural resources", "Construction", "Manufacturing",
    "Aerospace", "Other durable goods", "Nondurable goods", "Services producing",
    "Wholesale and retail trade", "Transportation and public utilities", "Information",
    "Financial activities", "Professional and business services", "Other services", "Government",
    "State and local", "Federal", "Housing permits (thous.)", "Population (thous.)",
    "Net migration (thous.)",
)
FORECAST_SHARES = (
    "Unemployment rate (%)", "Employment", "Personal income (cur. $)", "Consumer price index",
    "Housing permits", "Population",
)
FORECAST_BILLIONS = (
    "Personal income (bils. $12)", "Personal income (bils. $)", "Wage and salary disbursements",
    "Other income",
)
FORECAST_AS_IS = ("Per capita personal income ($)", "Consumer price index (82-84=1.000)")
FORECAST_JOBS = "Employment (thous.)"
RECESSIONS = (
    Event("COVID Recession", "2020-01-01", with_peak=True, search_from="2020-10-01"),
    Event("Great Recession", "2008-01-01"),
    Event("Dot-Com Recession", "2000-10-01", end="2005-10-01", below_peak=False),
)

SALE_YEARS = (2016, 2021)
KING_USES = (2, 4, 6, 8)
KING_LAST_PROPERTY_TYPE = 15
CONDO_TYPES_BELOW = 5
HIGH_DENSITY_CLASS = 2
PIERCE_EXCLUDED = ("Industrial", "Out Building")
PIERCE_TYPES = {
    1: ("Mobile or Manufactured Home",),
    2: ("Single Family Residential", "Single Family Residential "),
    3: (
        "Apartment Conv w/4-8 Units", "Apartment High Rise", "Apartment w/4-8 Units",
        "Apartments (Hi-Rise)", "Apt Low Rise 100 Units Plus", "Apt Low Rise 20 to 99 Units",
        "Apt Low Rise up to 19 Units", "Apts w/4-19 Units",
    ),
    4: ("Duplex", "Duplex Conv", "Townhouse", "Townhouse/Condo", "Triplex", "Triplex Conv"),
    5: ("Condo - Separate Unit", "Condo Apartment Low Rise", "Condo Low Rise"),
    6: ("Condo Apartment High Rise", "Condo High Rise"),
}
# Property class ranges (both ends kept) per housing type.
KITSAP_TYPES = {
    1: ((118, 119), (150, 150)),
    2: ((111, 111),),
    3: ((131, 138),),
    4: ((121, 123),),
    5: ((141, 141),),
}
SNOHOMISH_TYPES = {
    1: ((117, 119),),
    2: ((110, 115),),
    3: ((130, 139),),
    4: ((116, 116), (121, 124)),
    5: ((141, 145),),
}
KITSAP_CLASSES = (1, 150)
SNOHOMISH_CLASSES = (110, 145)
KITSAP_CUT_YEAR = 2017
