"""Unemployment claims: continuing, initial, and the weekly text report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiolume.functions.dates import parse_date
from regiolume.functions.numbers import ratio
from regiolume.functions.text import recode_chain, remove_all, wrap_text
from regiolume.operators.aggregate import strict_sum
from regiolume.operators.filters import drop_any_null
from regiolume.operators.joins import left_join, lookup
from regiolume.operators.project import names_like
from regiolume.operators.reshape import unpivot_except, unpivot_like
from regiolume.operators.setops import stack
from regiolume.operators.topk import slice_rows
from regiolume.plans import rules
from regiolume.sources.lines import report_blocks


def continuing_claims(
    tabs: DataFrame,
    rows: tuple[int, int],
    dropped: Sequence[str] = (),
    steps: Sequence[tuple[str, str]] = (),
    county: str = "county",
) -> DataFrame:
    """One tab per county, one column per week, to regional claims ``(demographic, date, estimate)``.

    The demographic's rows stand at fixed places of each tab. A number that is missing in one county
    makes the region's number missing. The label steps run in order, after the sum.
    """
    weeks = names_like(tabs, "(?i)week")
    part = slice_rows(tabs, *rows, per=[county]).filter(~F.col("Industry").isin(*dropped) if dropped else F.lit(True))
    long = unpivot_except(part.select("Industry", *[F.col(f"`{w}`").try_cast("double").alias(w) for w in weeks]),
                          ["Industry"], "week", "estimate")
    label = F.trim(remove_all("Industry", rules.CLAIM_TITLE))
    date = parse_date(remove_all("week", r".*ending\."), "mdy")
    sums = long.groupBy(label.alias("demographic"), date.alias("date")).agg(strict_sum("estimate").alias("estimate"))
    return sums.withColumn("demographic", recode_chain("demographic", steps))


def claims_by_race(tabs: DataFrame, county: str = "county") -> DataFrame:
    rows = continuing_claims(tabs, rules.CLAIM_RACE_ROWS, rules.CLAIM_RACE_DROPPED, rules.RACE_STEPS, county)
    return rows.filter(F.col("demographic") != "Unknown")


def claims_by_gender(tabs: DataFrame, county: str = "county") -> DataFrame:
    rows = continuing_claims(tabs, rules.CLAIM_GENDER_ROWS, (), rules.GENDER_STEPS, county)
    return rows.filter(F.col("demographic") != "Nonbinary")


def claim_share(claims: DataFrame, workforce: DataFrame, factor: float = 1.0) -> DataFrame:
    """Claims as a share of the workforce; groups the workforce lacks have no share."""
    joined = left_join(claims, workforce.select("demographic", "workforce"), "demographic")
    share = ratio("estimate", "workforce")
    return joined.filter(F.col("demographic") != "Total").withColumns({
        "share": share if factor == 1.0 else share * F.lit(factor),
        "year": F.year("date").cast("string"),
    })


def initial_claims_by(
    tab: DataFrame,
    category: str,
    rows: tuple[int, int] | None = None,
    dropped: Sequence[str] | None = None,
    classes: Mapping[str, str] = rules.EDUCATION_CLASSES,
    per: Sequence[str] = ("file",),
) -> DataFrame:
    """One tab: its label column and one column per county, summed over the counties."""
    rows = rules.INITIAL_CLAIM_ROWS[category] if rows is None else rows
    dropped = rules.INITIAL_CLAIM_DROPPED[category] if dropped is None else dropped
    label = next(c for c in tab.columns if c.endswith("of.Claimant"))
    counties = [f"{c}.County" for c in rules.COUNTIES]
    part = slice_rows(tab, *rows, per=per).select(
        F.trim(f"`{label}`").alias("demographic"), *[F.col(f"`{c}`") for c in counties]
    )
    long = unpivot_like(part, r"\.County$", "county", "value", "double")
    sums = long.groupBy("demographic").agg(strict_sum("value").alias("initial_claims"))
    if dropped:
        sums = sums.filter(~F.col("demographic").isin(*dropped))
    if category == "Race":
        sums = sums.withColumn("demographic", recode_chain("demographic", rules.RACE_STEPS))
    if category == "Education":
        sums = lookup(sums, classes, "demographic", "demographic").groupBy("demographic").agg(
            strict_sum("initial_claims").alias("initial_claims")
        )
    return sums.withColumn("category", F.lit(category))


def initial_claims_raw(tabs: Mapping[str, DataFrame], workforce: DataFrame, **options) -> DataFrame:
    """Initial claims of all demographics with their share of the workforce."""
    claims = stack(*[initial_claims_by(df, category, **options) for category, df in tabs.items()])
    people = workforce.filter(F.col("demographic") != "Total").select("demographic", "workforce")
    return left_join(claims, people, "demographic").withColumn("share", ratio("initial_claims", "workforce"))


def initial_claims(tabs: Mapping[str, DataFrame], workforce: DataFrame, width: int = 10, **options) -> DataFrame:
    """The same with the labels wrapped for display."""
    rows = initial_claims_raw(tabs, workforce, **options)
    return rows.withColumn("demographic", wrap_text("demographic", width))


def with_titles(rows: DataFrame, width: int = 10, dropped: Sequence[str] = ("Under age 24",)) -> DataFrame:
    """Keep the label and add a short wrapped title next to it; some groups are not shown."""
    title = recode_chain(wrap_text("demographic", width), rules.TITLE_STEPS)
    return rows.filter(~F.col("demographic").isin(*dropped)).withColumn("demographic_titles", title)


def weekly_claims(lines: DataFrame, first: int = rules.WEEKLY_CLAIM_FIRST_LINE, last: int | None = None) -> DataFrame:
    """Weekly claims from report text: two years side by side become ``(date, day, variable, value)``.

    ``day`` is the date in the later year's calendar, so that both years can be laid over each other. Lines that are no
    week of the report are dropped; ``first`` and ``last`` narrow the lines that are looked at.
    """
    names = ["date", "Initial Claims", "Weekly Change", "Percent Change", "4 Week Average"]
    earlier = [(i, n) for i, n in enumerate(names)] + [(5, "day")]
    later = [(i + 5, n) for i, n in enumerate(names)] + [(5, "day")]
    rows = report_blocks(lines, first, last, [earlier, later])
    typed = rows.select(
        parse_date("date", "mdy").alias("date"), parse_date("day", "mdy").alias("day"),
        *[F.col(f"`{n}`").try_cast("double").alias(n) for n in rules.WEEKLY_CLAIM_SERIES],
    )
    long = unpivot_except(typed, ["date", "day"], "variable", "value")
    return drop_any_null(long).withColumn("year", F.year("date"))
