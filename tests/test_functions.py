from datetime import date

import pytest
from pyspark.sql import functions as F

from regiolume.functions import dates, numbers, recode, text


def values(spark, ddl, data, *cols):
    df = spark.createDataFrame(data, ddl)
    return [tuple(r) for r in df.coalesce(1).select(*cols).collect()]


@pytest.mark.parametrize(
    "order, shown, want",
    [
        ("mdy", "2/29/2020", date(2020, 2, 29)),
        ("mdy", "2/29/2021", None),
        ("mdy", "12-1-21", date(2021, 12, 1)),
        ("mdy", "March 6, 2021", date(2021, 3, 6)),
        ("mdy", "1/2/99", date(1999, 1, 2)),
        ("mdy", "2020", None),
        ("mdy", None, None),
        ("ymd", "2021.04.05", date(2021, 4, 5)),
        ("ymd", "2021-13-01", None),
        ("ym", "2015-01", date(2015, 1, 1)),
        ("my", "Feb-12", date(2012, 2, 1)),
        ("my", "Feb-85", date(1985, 2, 1)),
        ("my", "Jan-68", date(2068, 1, 1)),
        ("my", "Jan-69", date(1969, 1, 1)),
        ("my", "JAN02", date(2002, 1, 1)),
        ("my", "September 2019", date(2019, 9, 1)),
        ("my", "Anf-12", None),
    ],
)
def test_parse_date(spark, order, shown, want):
    assert values(spark, "c string", [(shown,)], dates.parse_date("c", order)) == [(want,)]


def test_unknown_field_order_is_an_error(spark):
    with pytest.raises(KeyError):
        dates.parse_date("c", "dmy")


def test_quarters(spark):
    shown = ["2020:Q1", "2020 Q2", "2019 Quarter 3", "2020.4", "2020 Q5", "x", None]
    want = [date(2020, 1, 1), date(2020, 4, 1), date(2019, 7, 1), date(2020, 10, 1), None, None, None]
    assert [v for (v,) in values(spark, "c string", [(s,) for s in shown], dates.parse_quarter("c"))] == want


def test_date_blocks_and_anchors(spark):
    days = [(date(2021, 1, 1),), (date(2021, 1, 8),), (date(2020, 12, 31),), (date(2020, 2, 29),), (None,)]
    got = values(
        spark, "d date", days, dates.week_block("d"), dates.common_year("d"), dates.anchor_date(F.year("d")),
        dates.month_label("d"), dates.month_name("d", short=True),
    )
    assert got == [
        (1, date(2021, 1, 1), date(2021, 4, 1), "January-2021", "Jan"),
        (2, date(2021, 1, 8), date(2021, 4, 1), "January-2021", "Jan"),
        (53, date(2021, 12, 31), date(2020, 4, 1), "December-2020", "Dec"),
        (9, None, date(2020, 4, 1), "February-2020", "Feb"),
        (None, None, None, None, None),
    ]


def test_week_to_date_and_years_between(spark):
    got = values(
        spark, "w int, a date, b date", [(1, date(2008, 1, 1), date(2014, 4, 1)), (12, None, None)],
        dates.week_to_date("w"), dates.years_between("a", "b"),
    )
    assert got == [(date(2021, 1, 1), 6.3), (date(2021, 3, 19), None)]


def test_hours(spark):
    shown = [("5am_ratio",), ("Noon_ratio",), ("12pm",), ("8pm_ratio",), ("12am",), ("5:00 PM",), ("x",), (None,)]
    got = values(spark, "c string", shown, dates.hour_of_label("c"))
    assert [v for (v,) in got] == [5, 12, 12, 20, 0, 17, None, None]
    labels = values(spark, "h int", [(5,), (12,), (17,), (None,)], dates.hour_label("h"), dates.clock("h"))
    assert labels == [("5AM", "05:00:00"), ("12PM", "12:00:00"), ("5PM", "17:00:00"), (None, None)]


def test_text(spark):
    got = values(
        spark, "c string", [("banana (part) (part)",), ("",), (None,)],
        text.replace_all("c", "an", "x"), text.replace_first("c", "an", "x"), text.strip_part_suffix("c"),
        text.sub_text("c", 2, 4), text.sub_text("c", -3),
    )
    assert got == [
        ("bxxa (part) (part)", "bxana (part) (part)", "banana (part)", "ana", "rt)"),
        ("", "", "", "", ""), (None, None, None, None, None),
    ]


def test_recode_chain_keeps_the_order(spark):
    steps = [("Asian", "Asian Alone"), ("Alone", "Only")]
    got = values(spark, "c string", [("Asian",), ("South Asian",), (None,)], text.recode_chain("c", steps))
    assert got == [("Asian Only",), ("South Asian Only",), (None,)]


def test_concat_key_writes_missing_parts(spark):
    got = values(spark, "a string, b int", [("x", 1), (None, 2)], text.concat_key(["a", "b"]))
    assert got == [("x_1",), ("nan_2",)]


def test_wrap(spark):
    got = values(spark, "c string", [("the quick brown fox",), ("one",), ("longerthanwidth x",), (None,)], text.wrap_text("c", 10))
    assert got == [("the quick\nbrown fox",), ("one",), ("longerthanwidth\nx",), (None,)]


def test_numbers(spark):
    got = values(
        spark, "c string", [("12,345",), (" 7 ",), (".",), ("n/a",), (None,)],
        numbers.parse_number("c"), numbers.sentinel_number("c"),
    )
    assert got == [(12345, None), (7, 7.0), (None, None), (None, None), (None, None)]
    assert values(spark, "c string", [("-5%",), ("x",), (None,)], numbers.parse_percent("c")) == [(0.95,), (None,), (None,)]


def test_rounding_is_half_even(spark):
    got = values(spark, "x double", [(2.5,), (3.5,), (250.0,), (350.0,)], numbers.half_even("x"), numbers.half_even("x", -2))
    assert got == [(2.0, 0.0), (4.0, 0.0), (250.0, 200.0), (350.0, 400.0)]


def test_ratio_by_zero_is_missing(spark):
    got = values(spark, "a double, b double", [(1.0, 0.0), (1.0, 4.0), (None, 1.0)], numbers.ratio("a", "b"), numbers.pct_change("a", "b"))
    assert got == [(None, None), (0.25, -75.0), (None, None)]


def test_price_bins_at_their_edges(spark):
    prices = [0.0, 49_999.0, 50_000.0, 2_499_999.0, 2_500_000.0, -1.0, None]
    got = values(spark, "p double", [(p,) for p in prices], numbers.price_bin("p"))
    assert [v for (v,) in got] == [1, 1, 2, 50, 0, 0, 0]


def test_bands_at_their_edges(spark):
    upper = [(0.25, "Severe"), (0.5, "Heavy"), (0.75, "Moderate")]
    got = values(spark, "r double", [(0.25,), (0.26,), (0.5,), (0.75,), (0.76,), (None,)], numbers.bands("r", upper, "Minimal"))
    assert [v for (v,) in got] == ["Severe", "Heavy", "Heavy", "Moderate", "Minimal", None]


def test_unit_scale_without_a_class_is_missing(spark):
    got = values(
        spark, "v double, k string", [(2.0, "thousands"), (25.0, "shares"), (2.0, "other"), (2.0, None)],
        numbers.unit_scale("v", "k", {"thousands": 1000}, {"shares": 100}),
    )
    assert [v for (v,) in got] == [2000.0, 0.25, None, None]


def test_labels(spark):
    got = values(
        spark, "x double", [(1234567.5,), (-250.0,), (0.256,), (None,)],
        numbers.format_label("x", 1, "$"), numbers.format_label("x", -2), numbers.format_label("x", 0, suffix="%", factor=100.0),
    )
    assert got[0][:2] == ("$1,234,567.5", "1,234,600")
    assert got[1][:2] == ("$-250", "-200")
    assert got[2][2] == "26%"
    assert got[3] == (None, None, None)


def test_case_rules(spark):
    x = F.col("x")
    got = values(
        spark, "x int", [(1,), (5,), (9,), (None,)],
        recode.case_when([(x < 3, "low"), (x < 7, "mid")]), recode.last_match([(x < 7, 1), (x < 3, 2)], 0),
    )
    assert got == [("low", 2), ("mid", 1), (None, 0), (None, 0)]


def test_null_rules(spark):
    got = values(
        spark, "c string", [("a",), ("b",), (" ",), (None,)], recode.not_in_keep_null("c", ["a"]),
        recode.fill_null("c", "z"), recode.null_if("c", " "), recode.category_rank("c", ["b", "a"]),
    )
    assert got == [(False, "a", "a", 2), (True, "b", "b", 1), (True, " ", None, None), (True, "z", None, None)]
