"""Economic forecast: unit scaling, recession curves, years to recover."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiolume.functions.dates import quarter_start
from regiolume.functions.numbers import unit_scale
from regiolume.functions.recode import case_when
from regiolume.operators.filters import drop_any_null
from regiolume.operators.reshape import unpivot_except
from regiolume.operators.series import Event, event_curves, return_to_peak
from regiolume.plans import rules

TIMES = {"thousands": 1_000, "billions": 1_000_000_000, "as is": 1}
OVER = {"shares": 100}


def unit_class(metric: str) -> Column:
    """The metric's unit; a metric in no list has none and its estimate becomes NULL."""
    m = F.col(metric)
    return case_when([
        (m.isin(*rules.FORECAST_THOUSANDS), "thousands"),
        (m.isin(*rules.FORECAST_SHARES), "shares"),
        (m.isin(*rules.FORECAST_BILLIONS), "billions"),
        (m.isin(*rules.FORECAST_AS_IS), "as is"),
    ])


def forecast(table: DataFrame) -> DataFrame:
    """One column per quarter to ``(metric, quarter, estimate)`` in plain units.

    The first column is the metric, the second is dropped; a row with any missing cell is dropped.
    """
    metric, _, *quarters = table.columns
    rows = drop_any_null(table).select(F.col(f"`{metric}`").alias("metric"), *[F.col(f"`{q}`") for q in quarters])
    long = unpivot_except(rows, ["metric"], "head", "value", "double")
    # Heads are years with the quarter as tenths; a binary round trip leaves 1996.2999999999999 for 1996.3.
    tenths = F.round(F.col("head").try_cast("double") * 10).cast("long")
    q = F.pmod(tenths, F.lit(10)).cast("int")
    quarter = quarter_start(F.floor(tenths / 10).cast("int"), F.when(q.between(1, 4), q))
    estimate = unit_scale("value", unit_class("metric"), TIMES, OVER)
    return long.select("metric", quarter.alias("quarter"), estimate.alias("estimate"))


def recession_curves(data: DataFrame, events: Sequence[Event] = rules.RECESSIONS, metric: str = rules.FORECAST_JOBS) -> DataFrame:
    """Jobs by quarters since each peak: ``(event, quarter, estimate, index)``."""
    rows = data.filter(F.col("metric") == metric).select("quarter", "estimate")
    return event_curves(rows, [], "quarter", "estimate", events)


def years_to_recover(
    data: DataFrame, events: Sequence[Event] = rules.RECESSIONS, metric: str = rules.FORECAST_JOBS, legacy: bool = False
) -> DataFrame:
    rows = data.filter(F.col("metric") == metric).select("quarter", "estimate")
    return return_to_peak(rows, [], "quarter", "estimate", events, legacy=legacy)
