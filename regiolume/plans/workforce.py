"""Workforce by gender, race, age and education."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiolume.functions.dates import parse_quarter
from regiolume.functions.text import replace_all
from regiolume.operators.aggregate import strict_sum
from regiolume.operators.joins import lookup
from regiolume.operators.project import drop_like, names_like
from regiolume.operators.reshape import unpivot_except, unpivot_like
from regiolume.operators.setops import stack
from regiolume.operators.totals import add_total, merge_buckets
from regiolume.plans import rules


def workers_long(table: DataFrame, columns: str | None = None) -> DataFrame:
    """One column per category to ``(quarter, demographic, estimate)``.

    The first column is the quarter, whatever its name; flag columns are dropped. ``columns`` names
    the categories by pattern, otherwise all other columns are categories.
    """
    rows = drop_like(table, "Flags").withColumnRenamed(table.columns[0], "quarter")
    if columns is None:
        long = unpivot_except(rows, ["quarter"], "demographic", "estimate", "double")
    else:
        long = unpivot_like(rows.select("quarter", *[F.col(f"`{c}`") for c in names_like(rows, columns)]),
                            columns, "demographic", "estimate", "double")
    return long.select(
        parse_quarter(replace_all("quarter", " ", ":")).alias("quarter"),
        replace_all("demographic", r"\.", " ").alias("demographic"), "estimate",
    )


def at_quarter(workers: DataFrame, quarter: str = rules.WORKFORCE_QUARTER) -> DataFrame:
    """Workers of one quarter with their total; a missing category makes the total missing."""
    rows = workers.filter(F.col("quarter") == F.lit(quarter).cast("date"))
    total = add_total(rows, ["quarter"], "demographic", ["estimate"])
    return total.select("demographic", F.col("estimate").alias("workforce"))


def by_gender(table: DataFrame, quarter: str = rules.WORKFORCE_QUARTER) -> DataFrame:
    return at_quarter(workers_long(table), quarter)


def by_race(not_hispanic: DataFrame, hispanic: DataFrame, quarter: str = rules.WORKFORCE_QUARTER) -> DataFrame:
    """Races of workers that are not Hispanic, and Hispanic workers of any race as one more row."""
    return at_quarter(stack(workers_long(not_hispanic), workers_long(hispanic, r"^Hispanic\.or\.Latino$")), quarter)


def by_age(
    table: DataFrame,
    quarter: str = rules.WORKFORCE_QUARTER,
    merges: Mapping[str, Sequence[str]] = rules.AGE_MERGE,
    levels: Sequence[str] = rules.AGE_LEVELS,
) -> DataFrame:
    """Ages with the youngest two merged and the oldest open-ended."""
    ages = merge_buckets(at_quarter(workers_long(table, "-"), quarter), "demographic", [], ["workforce"], merges)
    shown = replace_all("demographic", *rules.AGE_OPEN_END)
    return ages.withColumn("demographic", shown).filter(F.col("demographic").isin(*levels))


def by_education(
    table: DataFrame, quarter: str = rules.WORKFORCE_QUARTER, classes: Mapping[str, str] | None = None
) -> DataFrame:
    """Education as published, or under the names of ``classes``."""
    rows = at_quarter(workers_long(table, r"\."), quarter)
    if classes is None:
        return rows
    return lookup(rows, classes, "demographic", "demographic").groupBy("demographic").agg(
        strict_sum("workforce").alias("workforce")
    )


def workforce(
    tables: Mapping[str, DataFrame], quarter: str = rules.WORKFORCE_QUARTER, classes: Mapping[str, str] | None = None
) -> DataFrame:
    """All four dimensions: ``(category, demographic, workforce)``.

    ``tables`` holds ``gender``, ``not_hispanic``, ``hispanic``, ``age`` and ``education``.
    """
    parts = {
        "Gender": by_gender(tables["gender"], quarter),
        "Race": by_race(tables["not_hispanic"], tables["hispanic"], quarter),
        "Age": by_age(tables["age"], quarter),
        "Education": by_education(tables["education"], quarter, classes),
    }
    return stack(*[df.withColumn("category", F.lit(name)) for name, df in parts.items()])
