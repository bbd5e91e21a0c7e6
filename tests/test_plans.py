from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from regiolume.operators.series import Event
from regiolume.plans import (
    charts, claims, congestion, employment, forecast, headlines, market, population, residential, rules, tax, travel, views,
    workforce,
)
from regiolume.schema import REGIONAL_SALES, indicator


# Congestion ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def segments(spark):
    data = [
        ("a", 2019, 2.0, 2.0, 0.25, 0.51), ("b", 2019, 1.0, 4.0, 0.5, None), ("c", 2020, 5.0, 1.0, 0.75, 0.9),
        ("d", 2020, 1.0, None, 0.2, 0.2),
    ]
    return spark.createDataFrame(data, "Tmc string, year int, miles double, thrulanes double, `5am_ratio` double, `Noon_ratio` double")


def test_congestion_levels(segments):
    got = {(r.year, r.hour, r.level): (r.lane_miles, r.share) for r in congestion.congestion_shares(segments).collect()}
    assert got[(2019, 5, "Severe")] == (4.0, 0.5) and got[(2019, 5, "Heavy")] == (4.0, 0.5)
    assert got[(2019, 12, "Moderate")] == (4.0, 0.5)
    assert got[(2019, 12, "Minimal")] == (4.0, 0.5)  # a missing ratio is a free road
    assert got[(2020, 5, "Moderate")] == (5.0, 0.83) and got[(2020, 5, "Severe")] == (1.0, 0.17)


def test_two_bands_and_profile(segments):
    shares = congestion.congestion_shares(segments, by="heavy")
    profile = congestion.severe_profile(shares, 2019, "Heavy Congestion")
    assert ("2019", "05:00:00", "5AM", 1.0) in rows(profile)
    with pytest.raises(ValueError):
        congestion.congestion_shares(segments, by="colour")


def test_heavy_share_and_its_legacy_form(segments):
    got = {(r.year, r.hour): (r.congested_miles, r.share) for r in congestion.heavy_share_by_hour(segments).collect()}
    assert got[(2019, 5)] == (8.0, 1.0)
    assert got[(2019, 12)] == (0.0, 0.0)
    assert got[(2020, 12)][0] == 0.0  # the segment without lanes adds nothing
    legacy = {(r.year, r.hour): (r.congested_miles, r.share) for r in congestion.heavy_share_by_hour(segments, legacy=True).collect()}
    assert legacy[(2019, 5)] == (0.75, 0.15)  # sums ratios, divides by 2020's lane-miles


# Travel ----------------------------------------------------------------------------------------


def test_weekly_screenings(spark):
    df = spark.createDataFrame([("Week 1", "1,234", "."), ("Week 2", None, "7")], "Week string, `2021` string, `2020` string")
    assert rows(travel.weekly_screenings(df)) == [
        (1, "2020", None, date(2021, 1, 1)), (1, "2021", 1234, date(2021, 1, 1)),
        (2, "2020", 7, date(2021, 1, 8)), (2, "2021", None, date(2021, 1, 8)),
    ]


def test_weekly_median_is_missing_when_a_day_is(spark):
    days = [(f"1/{d}/2021", f"{d},000", None if d == 3 else str(d)) for d in range(1, 9)]
    df = spark.createDataFrame(days, "Date string, `2021 Traveler Throughput` string, `2020 Traveler Throughput` string")
    assert rows(travel.weekly_median(df)) == [("2020", 1, None), ("2020", 2, 8.0), ("2021", 1, 4000.0), ("2021", 2, 8000.0)]
    assert rows(travel.weekly_median(df, is_strict=False))[0] == ("2020", 1, 4.5)


def test_transit(spark):
    head = "`4.digit.NTD.ID` string, `5.digit.NTD.ID` string, Agency string, Active string, `Reporter.Type` string, UZA int, `UZA.Name` string, Modes string, TOS string, JAN20 double, FEB20 double, JAN21 double"
    data = [
        ("1", "", "City of Everett", "", "", 1, "", "MB", "", 5.0, 7.0, 2.0), ("40", "", "King County Ferry District", "", "", 1, "", "FB", "", 1.0, None, 1.0),
        ("1", "", "City of Everett", "", "", 1, "", "DR", "", 9.0, 9.0, 9.0), ("2", "", "Elsewhere", "", "", 1, "", "MB", "", 9.0, 9.0, 9.0),
    ]
    months = travel.transit_months(spark.createDataFrame(data, head))
    assert months.count() == 5
    assert rows(travel.transit_ytd(months, 2010), "agency", "year", "mode", "estimate") == [
        ("Everett Transit", 2020, "Bus", 5.0), ("Everett Transit", 2021, "Bus", 2.0),
        ("King County Metro", 2020, "Ferry", 1.0), ("King County Metro", 2021, "Ferry", 1.0),
    ]
    assert rows(travel.year_ratio(travel.transit_ytd(months, 2010), 2021, 2020)) == [(0.5,)]
    assert (date(2020, 2, 1), 7.0, "2020", date(2021, 2, 1)) in rows(travel.transit_overlay(months))


def test_volumes(spark):
    data = [
        ("I-5", "King", "I-5 at A", "Mon 01/04/21", "", "Current", "Mon", 50, 100), ("I-90", "King", "I-90 at B", "Mon 01/04/21", "", "Current", "Mon", 30, 10),
        ("I-5", "King", "I-5 at A", "Mon 01/04/20", "", "Current", "Mon", 50, 100), ("US 2", "Chelan", "US 2", "Mon 01/04/21", "", "Current", "Mon", 1, 1),
        ("I-5", "King", "I-5 at A", "Mon 01/04/21", "", "Previous", "Mon", 1, 1),
    ]
    table = spark.createDataFrame(data, list(rules.HIGHWAY_COLUMNS))
    volumes = travel.highway_volumes(table)
    assert rows(travel.corridor_ratios(volumes)) == [
        ("All highways", 80.0, 110.0, 80 / 110), ("Cross-lake", 30.0, 10.0, 3.0), ("I-5 and I-405", 50.0, 100.0, 0.5)
    ]
    assert rows(travel.clipped_index(volumes)) == [("I-5 at A", date(2021, 1, 4), 0.5)]
    trucks = spark.createDataFrame([("SR 16", "Pierce", "SR 16 at C", "x 02/01/21", "", "", "", "-5%"), ("SR 16", "Pierce", "SR 16 at C", "x 02/02/21", "", "", "", "")], list(rules.TRUCK_COLUMNS))
    assert rows(travel.truck_volumes(trucks), "date", "ratio") == [(date(2021, 2, 1), 0.95)]
    ferries = spark.createDataFrame(
        [("1/2/2021", "", "Seattle - Bremerton", rules.FERRY_BASE, 0, 200.0), ("1/2/2021", "", "Seattle - Bremerton", rules.FERRY_CURRENT, 0, 50.0),
         ("1/2/2021", "", "Seattle - Bremerton", rules.FERRY_CHANGE, 0, -0.75), ("1/2/2021", "", "Other", rules.FERRY_BASE, 0, 9.0)], list(rules.FERRY_COLUMNS))
    assert rows(travel.ferry_ratio(ferries)) == [(50.0, 200.0, 0.25)]
    assert rows(travel.ferry_series(ferries), "ratio") == [(0.25,)]


# Jobs, workforce, claims -----------------------------------------------------------------------


def test_hidden_sector_is_the_residual(spark):
    head = "geography string, `NAICS.CELL` int, `NAICS.INDUSTRY` string, `2021-01-01` double, `2021-02-01` double"
    data = [
        ("Bremerton MSA", 0, " Private Service Providing", 100.0, 110.0), ("Bremerton MSA", 0, "  Information", 30.0, None),
        ("Bremerton MSA", 0, " Government ", 20.0, 20.0), ("Bremerton MSA", 0, "Mining, Logging, and Construction", 7.0, 7.0),
        ("Seattle MSA", 0, "Other Services", 5.0, 5.0), ("Washington State", 0, "Other Services", 999.0, 999.0),
    ]
    jobs = employment.sector_jobs(spark.createDataFrame(data, head))
    got = {(r.geography, r.sector, r.month.month): r.jobs for r in jobs.collect()}
    assert got[("Bremerton MSA", "Other Services", 1)] == 70.0
    assert got[("Bremerton MSA", "Other Services", 2)] is None  # a named sector is missing
    assert got[("Region", "Other Services", 1)] == 75.0 and got[("Region", "Other Services", 2)] is None
    assert got[("Bremerton MSA", "Construction", 1)] == 7.0
    total = employment.total_jobs(jobs.withColumn("sector", F.lit("Total Nonfarm")))
    assert set(total.columns) >= {"year", "date"}
    assert rows(employment.lowest_month(jobs.withColumn("sector", F.lit("Total Nonfarm")), 2021), "jobs") == [(7.0,), (7.0,)]  # ties are kept


def test_workforce(spark):
    table = spark.createDataFrame(
        [("2020 Q1", 10.0, "", 4.0, 6.0, 1.0), ("2019 Q4", 9.0, "", 9.0, 9.0, 9.0)],
        "X1 string, `19-21` double, `Flags` string, `22-24` double, `65-99` double, `14-18` double",
    )
    assert rows(workforce.by_age(table)) == [("18-24", 14.0), ("65+", 6.0), ("Total", 21.0)]
    gender = spark.createDataFrame([("2020 Q1", 3.0, None)], "X1 string, Male double, Female double")
    assert rows(workforce.by_gender(gender)) == [("Female", None), ("Male", 3.0), ("Total", None)]


def test_claims_keep_only_their_block_and_share_the_workforce(spark):
    labels = ["Male", "Female", "Nonbinary/Other", "Total", "x", "y", " African American", " Asian", "Not Latino/Hispanic:", " Unknown", "Not Disclosed"]
    data = [("King", i + 1, label, "", str(i + 1), "." if label == " Asian" else "1") for i, label in enumerate(labels)]
    data += [("Pierce", i + 1, label, "", "1", "1") for i, label in enumerate(labels)]
    tabs = spark.createDataFrame(data, "county string, pos int, Industry string, Demographic string, `Week.1.ending.March.7,.2020` string, `Week.2.ending.March.14,.2020` string")
    got = rows(claims.claims_by_race(tabs))
    assert got == [
        ("Asian Alone", date(2020, 3, 7), 9.0), ("Asian Alone", date(2020, 3, 14), None),
        ("Black or African American Alone", date(2020, 3, 7), 8.0), ("Black or African American Alone", date(2020, 3, 14), 2.0),
    ]
    people = spark.createDataFrame([("Male", 10.0), ("Total", 99.0)], "demographic string, workforce double")
    shares = rows(claims.claim_share(claims.claims_by_gender(tabs), people), "demographic", "date", "share", "year")
    assert shares[2:] == [("Male", date(2020, 3, 7), 0.2, "2020"), ("Male", date(2020, 3, 14), 0.2, "2020")]
    assert shares[0][2] is None


def test_initial_claims_by_education(spark):
    head = "file string, pos int, `Formal.Education.of.Claimant` string, `King.County` int, `Kitsap.County` int, `Pierce.County` int, `Snohomish.County` int, `Adams.County` int"
    tab = spark.createDataFrame([
        ("f", 1, "Total", 9, 9, 9, 9, 9), ("f", 2, "PhD ", 1, 2, 3, 4, 9), ("f", 3, " Master's Degree", 1, 1, 1, 1, 9), ("f", 4, "Mystery", 1, 1, 1, 1, 9),
    ], head)
    got = rows(claims.initial_claims_by(tab, "Education"), "demographic", "initial_claims")
    assert got == [(None, 4.0), ("Bachelor's degree or advanced degree", 14.0)]


# Population ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pop_table(spark):
    data = [
        (1, "1", "King", "King County", "100", "111"), (2, "4", "King", "Auburn (part)", "40", "46"), (3, "4", "Pierce", "Auburn (part)", "5", "6"),
        (4, "4", "King", "Kent", "20", "."), (5, "2", "King", "Unincorporated King County", "30", "31"), (6, "1", "State", "State Total", "900", "950"),
        (7, "1", "Yakima", "Yakima County", "50", "50"), (8, "4", "King", "Tukwila", "10", "19"),
    ]
    return spark.createDataFrame(data, "Line int, Filter string, County string, Jurisdiction string, `2020.Population.Estimate` string, `2021.Population.Estimate` string")


def test_population_merges_parts_and_sums_levels_apart(pop_table):
    got = {(r.level, r.place, r.year): r.estimate for r in population.population(pop_table, rules.COUNTIES).collect()}
    assert got[(4, "Auburn", 2021)] == 52.0 and got[(4, "Kent", 2021)] is None
    assert got[(1, "Region", 2020)] == 100.0 and got[(2, "Unincorporated Region Total", 2021)] == 31.0
    assert not any(place == "Yakima County" for _, place, _ in got)


def test_growth(spark, pop_table):
    dims = population.jurisdictions(spark.createDataFrame(
        [("Auburn", "Core", "No", "033"), ("Auburn", "Core", "No", "053"), ("Kent", "Core", "No", "033"), ("Tukwila", "HCT", "No", "033"),
         ("Silverdale", "HCT", "No", "035"), ("King Uninc. Area", "x", "No", "033")],
        "juris_name string, regional_geography string, airport_affected string, county_fips string"))
    assert rows(dims, "place", "regional_geography", "airport_affected", "county_name") == [
        ("Auburn", "Core Cities", "Yes", "King County"), ("Kent", "Core Cities", "Yes", "King County"),
        ("Tukwila", "High Capacity Transit Community", "Yes", "King County")]
    people = population.population(pop_table, rules.COUNTIES, rules.REGION_LEVELS_SHORT)
    growth = population.place_growth(people, dims, 2021)
    assert rows(population.growth_by_class(growth, 2021), "regional_geography", "delta", "delta_rounded") == [
        ("Core Cities", 7.0, 10.0), ("High Capacity Transit Community", 9.0, 10.0)]
    assert [r.place for r in population.fastest_places(growth, 2021, 2).collect()] == ["Tukwila", "Auburn"]
    assert rows(population.place_table(growth, 2020, 2021)) == [
        ("Auburn", "King County", 40.0, 50.0, 10.0), ("Kent", "King County", 20.0, None, None), ("Tukwila", "King County", 10.0, 20.0, 10.0)]
    report = population.growth_report(growth, 2021)
    assert len(report) == 9 and all(df.columns for df in report.values())


def test_components(spark):
    table = spark.createDataFrame(
        [("", "King", "King (part)", "5", "7"), ("", "State", "State", "50", "70"), ("", "Yakima", "Yakima", "1", "1")],
        "Spacer string, County string, Jurisdiction string, `Natural.Increase.2019-2020` string, `Natural.Increase.2020-20211` string")
    got = rows(population.components_of_change({"Natural.Increase": table}), "level", "place", "year", "estimate")
    assert got == [(4, "King", 2020, 5.0), (4, "King", 2021, 7.0), (4, "State", 2020, 50.0), (4, "State", 2021, 70.0),
                   (5, "Region", 2020, 5.0), (5, "Region", 2021, 7.0)]


def test_housing(spark):
    heads = ["2020.Census.Count.of.Total.Housing.Units", "2021.Postcensal.Estimate.of.One.Unit.Housing.Units",
             "2020.Postcensal.Estimate.of.One.Unit.Housing.Units"]
    ddl = "Line int, Filter string, County string, Jurisdiction string, " + ", ".join(f"`{h}` string" for h in heads)
    table = spark.createDataFrame([(1, "1", "King", "King County", "10", "7", "5"), (2, "4", "King", "Kent", "n/a", "3", "2")], ddl)
    units = population.housing_units(table)
    got = {(r.level, r.place, r.year, r.variable): r.estimate for r in units.collect()}
    assert got[(4, "Kent", 2020, "Total Housing Units")] == 0.0
    assert got[(5, "Region", 2021, "One Unit Housing Units")] == 7.0  # counties only, places are not added
    assert rows(population.housing_change(units, 2020), "unit_type", "year", "delta") == [("Single-Family", 2021, 2.0)]


def test_postcensal_series(spark):
    heads = ["2019\r\n Postcensal Estimate of Total Population", "2020\r\n Postcensal Estimate of Total Population",
             "2020\r\n Census Count of Total Population", "Note.1"]
    ddl = "Line int, Filter int, County string, Jurisdiction string, " + ", ".join(f"`{h}` string" for h in heads)
    table = spark.createDataFrame([(1, 1, "King", "King County", "5", "6", "7", ""), (2, 3, "King", "Inc", ".", "1", "2", "")], ddl)
    got = rows(population.postcensal_population(table), "place", "year", "estimate", "variable")
    assert got == [("Inc", 2020, 2.0, "Population"), ("Incorporated Region", 2020, 2.0, "Population"), ("King County", 2019, 5.0, "Population"),
                   ("King County", 2020, 7.0, "Population"), ("Region", 2019, 5.0, "Population"), ("Region", 2020, 7.0, "Population")]


def test_place_classes_and_change(spark):
    cities = spark.createDataFrame([("Auburn", "King", "Core"), ("Auburn", "Pierce", "Core"), ("Sea Tac", "King", "Core"), ("Kent", "King", None)],
                                   "city_name string, cnty_name string, class_desc string")
    classes = population.place_classes(cities)
    assert rows(classes) == [("Auburn", "King & Pierce", "Core"), ("Kent", "King", None), ("SeaTac", "King", "Core")]
    people = spark.createDataFrame([(4, "Auburn", y, float(y - 2000)) for y in (2010, 2021)] + [(2, "Unincorporated King", 2021, 5.0), (4, "Kent", 2021, 9.0),
                                   (1, "Region", 2021, 99.0)], "level int, place string, year int, estimate double").withColumn("variable", F.lit("Total Population"))
    got = rows(population.class_change(people, classes, "Total Population", 2010, 2021), "class_desc", "delta", "place_in_order")
    assert got == [("Core", 11.0, 2), ("Unincorporated", None, 5)]


# Market, tax, forecast -------------------------------------------------------------------------


def test_rents_and_sales(spark):
    table = spark.createDataFrame([(1, "Seattle, WA", 0, 1500.5, None), (2, "Else", 1, 1.0, 1.0)], "RegionID int, RegionName string, SizeRank int, `2015-01` double, `2015-02-28` double")
    assert rows(market.rents(table, "Seattle, WA")) == [("Seattle, WA", date(2015, 1, 1), 1500.5), ("Seattle, WA", date(2015, 2, 28), None)]
    assert ("Seattle, WA", date(2015, 1, 1), "January-2015", 1500.0) in rows(market.rents_labelled(table, "Seattle, WA"))
    sales = spark.createDataFrame([("Feb-12", 5, 6, 7)], "`Month.of.Period.End` string, `Median.Sale.Price` int, `Homes.Sold` int, Inventory int")
    assert rows(market.home_sales(sales)) == [(date(2012, 2, 1), "Home Inventory", 7.0), (date(2012, 2, 1), "Homes Sold", 6.0), (date(2012, 2, 1), "Median Sales Price", 5.0)]


def test_sales_tax(spark):
    data = [
        (0, "Auburn/king", " ", " ", " ", " "), (1, "2019 Quarter 3", "Sales", "44", "3", "100"), (2, "2021 Quarter 3", "Sales", "44", "3", "150"),
        (3, "2021 Quarter 3", "Use", "44", "3", "7"), (4, "Auburn/pierce", " ", " ", " ", " "), (5, "2019 Quarter 3", "Sales", "44", "3", "20"),
        (6, "2021 Quarter 3", "Sales", "44", "3", "30"), (7, "Seatac", " ", " ", " ", " "), (8, "2019 Quarter 3", "Sales", "44", "3", "10"),
        (9, "2021 Quarter 3", "Sales", "44", "3", " "),
    ]
    table = spark.createDataFrame(data, "pos int, Year string, `Tax.Type` string, NAICS string, Units string, `Total.Taxable` string")
    sales = tax.quarterly_sales(table)
    assert sales.count() == 6
    assert rows(tax.quarterly_sales(table, block=F.floor(F.col("pos") / 2))) == rows(sales)
    assert (date(2021, 7, 1), "Sales", 180.0) in rows(tax.region_sales(sales))
    cities = spark.createDataFrame([("Auburn", "Core")], "city_name string, class_desc string")
    got = rows(tax.city_ratios(sales, cities, "2019-07-01", "2021-07-01"), "geography", "base", "current", "ratio", "class_desc")
    assert got == [("Auburn", 120.0, 180.0, 1.5, "Core"), ("Sea Tac", 10.0, None, None, "Unincorporated County")]


def test_forecast(spark):
    heads = ["2000.4", "2001.0999999999999", "2001.2", "2001.4000000000001"]
    ddl = "Metric string, Note string, " + ", ".join(f"`{h}` double" for h in heads)
    table = spark.createDataFrame([("Employment (thous.)", "x", 2.0, 1.5, 1.0, 3.0), ("Unemployment rate (%)", "x", 5.0, 5.0, 5.0, 5.0),
                                   ("Housing permits", "x", None, 1.0, 1.0, 1.0), ("Other", "x", 1.0, 1.0, 1.0, 1.0)], ddl)
    data = forecast.forecast(table)
    got = {(r.metric, r.quarter): r.estimate for r in data.collect()}
    assert got[("Employment (thous.)", date(2001, 1, 1))] == 1500.0 and got[("Employment (thous.)", date(2001, 10, 1))] == 3000.0
    assert got[("Unemployment rate (%)", date(2000, 10, 1))] == 0.05 and got[("Other", date(2001, 4, 1))] is None
    assert not any(m == "Housing permits" for m, _ in got)  # one cell is missing
    events = [Event("dip", "2000-10-01")]
    assert rows(forecast.recession_curves(data, events), "index", "estimate") == [(1, 1500.0), (2, 1000.0)]
    assert forecast.years_to_recover(data, events).first().years == 1.0
    assert forecast.years_to_recover(data, events, legacy=True).first().years == 0.0


# Residential sales -----------------------------------------------------------------------------


def test_king_rules_and_bulk_sales(spark):
    head = "major string, minor string, documentdate string, saleprice double, buyername string, propertytype int, principaluse int"
    sales = spark.createDataFrame([
        ("000001", "0010", "1/5/2020", 49_999.0, "A B", 3, 6), ("000002", "0010", "1/5/2020", 500_000.0, "BULK", 3, 6), ("000003", "0010", "1/5/2020", 500_000.0, "BULK", 3, 6),
        ("000004", "0010", "1/6/2020", 2_500_000.0, None, 3, 2), ("000005", "0010", "1/7/2020", 1.0, "C", 16, 6), ("000006", "0010", "1/8/2015", 1.0, "C", 3, 6),
        ("000007", "0010", "1/9/2021", 0.0, "C", 3, 6), ("000008", "0010", "2/9/2021", 60_000.0, "D", 3, 8), ("000009", "0010", "2/10/2021", 60_000.0, "D", 3, 7),
        ("000011", "0000", "3/10/2021", 70_000.0, "E", 3, 6), ("000012", "0000", "3/11/2021", 70_000.0, "E", 3, 6)], head)
    condos = spark.createDataFrame([("000004", "0010", 1), ("000004", "0010", 3), ("000011", "0000", 2), ("000001", "0010", 5)], "major string, minor string, unittype int")
    complexes = spark.createDataFrame([("000012", 1), ("000001", 4)], "major string, constrclass int")
    got = {r.parcel_number: (r.year, r.price_bin, r.housing_type) for r in residential.king_sales(sales, condos, complexes).collect()}
    assert got == {"000001-0010": (2020, 1, 2), "000004-0010": (2020, 0, 5), "000008-0010": (2021, 2, 1), "000011-0000": (2021, 2, 4), "000012-0000": (2021, 2, 6)}
    # Adding the key's parts up makes 1 + 10 and 11 + 0 the same parcel.
    legacy = {r.month: r.housing_type for r in residential.king_sales(sales, condos, complexes, legacy=True).filter("sale_price = 49999").collect()}
    assert legacy == {1: 4}


def test_other_counties(spark):
    early = spark.createDataFrame([("1", "5/1/2016", 10.0), ("1", "5/1/2018", 99.0), ("1", "5/1/2014", 1.0)], "acct_no string, sale_dt string, price double")
    late = spark.createDataFrame([("1", "5/1/2018", "1,000"), ("2", "5/2/2018", "7"), ("3", "5/2/2018", "7")], "`tax parcel no.` string, `sale dt` string, price string")
    parcels = spark.createDataFrame([("1", 111), ("2", 141), ("3", 151)], "acct_no string, property_class int")
    got = rows(residential.kitsap_sales(early, late, parcels), "parcel_number", "year", "sale_price", "housing_type")
    assert got == [("1", 2016, 10.0, 2), ("1", 2018, 1000.0, 2), ("2", 2018, 7.0, 5)]
    sales = spark.createDataFrame([("a", "1/2/2019", 5, "X Y"), ("b", "1/2/2019", 5, "X_Y"), ("a", "1/3/2019", 6, None), ("z", "1/3/2019", 7, "Q")], "parcel_number string, sale_date string, sale_price int, grantee string")
    built = spark.createDataFrame([("a", "Residential", "Duplex"), ("a", "Out Building", "Condo High Rise"), ("a", None, "Single Family Residential "), ("b", "Residential", "Triplex"), ("z", "Residential", "Barn")],
                                  "parcel_number string, property_type string, occupancy_description string")
    assert rows(residential.pierce_sales(sales, built), "parcel_number", "sale_price", "housing_type") == [("a", 6.0, 4)]
    snoh = spark.createDataFrame([("p", 116, "1 Main", "4-5-19", "350,000", "N"), ("q", 150, "1 Main", "4-5-19", "1", "N"), ("r", 130, None, "4-5-19", "2", "N"), ("s", 145, "x", "4-5-15", "3", "N")],
                                 "parcel_id string, prop_class int, propertystreet string, sale_date string, sale_price string, ownername1 string")
    out = residential.snohomish_sales(snoh)
    assert rows(out) == [("p", 4, 2019, 350_000.0, 8, 4, "snohomish")]
    assert [f.name for f in out.schema.fields] == list(REGIONAL_SALES)
    report = residential.sales_report(out.unionByName(out))
    assert rows(report["median_price_by_type_region"]) == [(2019, 4, "snohomish", 350_000.0)]
    assert rows(report["summarized_transactions_by_year_type_region"]) == [(2019, 4, "snohomish", 2)]


def test_buildings_in_one_pass(spark):
    b = spark.createDataFrame([("1", "2", 1, 900, "98101"), ("1", "2", 3, 800, "98109"), ("1", "2", 0, 9999, "98101")], "major string, minor string, nbrlivingunits int, sqfttotliving int, zipcode string")
    assert rows(residential.king_buildings(b)) == [("1", "2", 3, 900, "98109")]


# Headlines, charts, views ----------------------------------------------------------------------


def test_growth_headlines_keep_ties(spark):
    data = []
    for y, (m, n, t) in {2011: (10, 5, 1500.0), 2012: (900, 700, 1600.0), 2013: (50, 5, 1400.0), 2021: (1000.0, 490.0, 1490.0)}.items():
        data += [("Region", "Migration", y, float(m)), ("Region", "Natural Increase", y, float(n)), ("Region", "Total Change", y, float(t))]
    out = rows(headlines.growth_headlines(spark.createDataFrame(data, "place string, variable string, year int, estimate double")))
    got = dict(out)
    assert got["population change"] == 1500.0 and got["latest year"] == 2021.0
    assert got["year of largest change"] == 2012.0 and got["migration share of largest change"] == 56.0
    assert [v for k, v in out if k == "most similar year"] == [2011.0]


def test_indicator_schema(spark):
    df = spark.createDataFrame([("A", "jobs", date(2020, 1, 1), 5)], "g string, v string, d date, n int")
    out = indicator(df, "g", "v", "d", "n")
    assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields] == [("geography", "string"), ("variable", "string"), ("period", "date"), ("estimate", "double")]


def test_chart_dataset(spark):
    df = spark.createDataFrame([(2020, 0.256, "b"), (2021, None, "zz")], "year int, share double, grp string")
    out = charts.chart_dataset(df, "year", "share", "grp", digits=0, factor=100, suffix="%", levels=["a", "b"])
    assert rows(out, "x", "y", "group", "facet", "label", "place") == [(2020, 0.256, "b", None, "b: 26%", 2), (2021, None, "zz", None, None, None)]


def test_views(spark):
    shares = spark.createDataFrame([(2019, "Region", "Asian Alone", "Own", 1.0, 0.6), (2019, "Region", "White alone", "Own", 1.0, 0.4), (2019, "Region", "x", "Rent", 1.0, 0.1)],
                                   "year int, geography string, grouping string, variable string, estimate double, share double")
    assert [r.race for r in views.home_owners(shares, 2019).collect()] == ["White", "Asian"]
    assert views.work_from_home(shares, 2019).count() == 0
    jobs = spark.createDataFrame([("2014-12-01", "Region", "Total Nonfarm", 1.0), ("2023-05-01", "Region", "Total Nonfarm", 2.0), ("2023-04-01", "Region", "Information", 3.0), ("2015-01-01", "Region", "Total Nonfarm", 4.0)],
                                 "date string, geography string, variable string, estimate double")
    assert rows(views.jobs_total(jobs), "estimate") == [(2.0,), (4.0,)]
    assert rows(views.jobs_total(jobs, unfinished=["May-2023"]), "estimate") == [(4.0,)]
    assert rows(views.industries(jobs)) == [("Information",)]
    sales = spark.createDataFrame([("r", "Feb-12", 5, 6, 7, 8)], "region string, period string, price int, sales int, listings int, inventory int")
    assert rows(views.home_sales(sales, "listings"), "year", "geography", "estimate") == [("February-2012", "r", 7)]
    with pytest.raises(ValueError):
        views.home_sales(sales, "region")


def test_recuts(spark, pop_table):
    school = spark.createDataFrame([("2020 Q1", 3.0, 4.0, 5.0)], "X1 string, `Less.than.high.school` double, `High.school.or.equivalent,.no.college` double, `Flags.x` double")
    assert rows(workforce.by_education(school, classes=rules.EDUCATION_CLASSES_SHORT)) == [("High School", 4.0), ("Less than high school", 3.0), ("Total", 7.0)]
    titled = claims.with_titles(spark.createDataFrame([("Asian Alone",), ("Under age 24",), ("Hispanic or Latino",)], "demographic string"))
    assert rows(titled) == [("Asian Alone", "Asian\n"), ("Hispanic or Latino", "Hispanic\nor Latinx")]
    people = population.population(pop_table, rules.COUNTIES)
    assert rows(population.place_years(people, "Total Population", ["Kent", "Auburn"], [2020]), "place", "year", "estimate", "place_in_order") == [
        ("Auburn", "2020", 45.0, 2), ("Kent", "2020", 20.0, 1)]
    top = spark.createDataFrame([("a", "King County"), ("b", "King County")], "place string, county_name string")
    assert rows(population.counts_by_county(top)) == [("King County", 2)]
    named = spark.createDataFrame([("I-5", "King", "Current", "Mon, 01/04/21 x", "I-5 at A", 30.0, 10.0), ("I-5", "King", "Current", "Tue, 01/05/21 x", "I-5 at A", 5.0, 10.0), ("I-5", "King", "Other", "Mon, 01/04/21 x", "I-5 at A", 1.0, 1.0)],
                                  "Highway1 string, Counties string, `Measure Names` string, `Day of 2020Date` string, `Traffic Count Locations` string, `Measure Values` double, `2019 Volume` double")
    volumes = travel.location_volumes(named)
    assert rows(travel.clipped_index(volumes, locations=["I-5 at A"])) == [("I-5 at A", date(2021, 1, 5), 0.5)]
    assert travel.clipped_index(volumes, locations=["elsewhere"]).count() == 0
