"""Database tables and small in-line lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    source: str,
    columns: Sequence[str],
    url: str | None = None,
    **options: Any,
) -> DataFrame:
    """A table from a database (with ``url``) or from Parquet, cut to the columns asked for.

    Spatial layers come the same way: naming the attribute columns leaves the geometry behind in
    the database. For a large table pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` so that the read is parallel.
    """
    if url is None:
        return spark.read.parquet(source).select(*columns)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", source)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select(*columns)


def inline_lookup(
    spark: SparkSession, mapping: Mapping[str, Any], key: str = "name", value: str = "value"
) -> DataFrame:
    """A mapping written in the program as a two-column table."""
    rows = ", ".join(f"(:k{i}, :v{i})" for i in range(len(mapping)))
    args = {}
    for i, (k, v) in enumerate(mapping.items()):
        args |= {f"k{i}": k, f"v{i}": v}
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(`{key}`, `{value}`)", args=args)
