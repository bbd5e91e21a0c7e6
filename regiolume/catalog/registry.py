"""Registry of catalogue queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: SQL list of the years that orders were placed in, for the grids of the stand-ins.
YEARS_SQL = "range((select min(year(o_orderdate)) from orders), (select max(year(o_orderdate)) + 1 from orders))"


class Tables:
    """The benchmark tables of one scale factor, read lazily by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def years(self) -> range:
        """The years that orders were placed in: the calendar of the wide stand-ins."""
        day = F.year("o_orderdate")
        first, last = self.orders.agg(F.min(day), F.max(day)).first()
        return range(first, last + 1) if first is not None else range(0)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a name, with its SQL where SQL can say it."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__doc__ = fn.__doc__
        run.__name__ = name
        ENTRIES[name] = Entry(run, sql)
        return fn

    return add
