"""Deliveries read by a table of layouts, with the lines that do not fit kept apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiolume.sources.delimited import QUOTED, text_schema

_BROKEN = "__broken"


@dataclass(frozen=True)
class Layout:
    """How a delivery is laid out: the wanted columns with their types, and how its files are written.

    Without ``order`` the files have a header, and columns are found by its names whatever their case; with it
    they have none, and ``order`` names all their columns. A line whose ``keys`` are not all filled is rejected.
    """

    columns: Mapping[str, str]
    sep: str = ","
    encoding: str = "UTF-8"
    order: Sequence[str] = ()
    keys: Sequence[str] = field(default_factory=tuple)


def _texts(spark: SparkSession, paths: str | Sequence[str], layout: Layout) -> DataFrame:
    """All columns as text, named in small letters, and the line itself where its cells do not fit the header."""
    reader = (
        spark.read.options(**QUOTED).option("sep", layout.sep).option("encoding", layout.encoding).option("recursiveFileLookup", True)
        .option("columnNameOfCorruptRecord", _BROKEN).option("columnPruning", False)
    )
    if layout.order:
        names, reader = list(layout.order), reader.option("header", False)
    else:
        names, reader = reader.option("header", True).csv(paths).columns, reader.option("header", True).option("enforceSchema", False)
    table = reader.schema(text_schema([*names, _BROKEN])).csv(paths)
    return table.select(
        *[F.col(f"`{c}`").alias(c.lstrip("﻿").strip().lower()) for c in names], _BROKEN, F.col("_metadata.file_path").alias("__file")
    )


def _filled(name: str) -> Column:
    return F.coalesce(F.trim(F.col(f"`{name}`")) != "", F.lit(False))


def read_layout(spark: SparkSession, paths: str | Sequence[str], layout: Layout) -> tuple[DataFrame, DataFrame]:
    """The rows of a delivery, and its rejected lines as ``(file, reason, line)``.

    A line is rejected when it has more or fewer cells than the header (``cells``), when a key is empty (``key <name>``) or when
    a filled cell does not fit its type (``type <name>``); the first of these reasons is given. All other lines are rows: an
    empty cell is NULL. No line is in both tables or in none.
    """
    texts = _texts(spark, paths, layout)
    columns = {name.lower(): kind for name, kind in layout.columns.items()}
    reason = F.lit(None).cast("string")
    for name, kind in reversed(columns.items()):
        misfit = _filled(name) & F.col(f"`{name}`").try_cast(kind).isNull()
        reason = F.when(misfit, F.lit(f"type {name}")).otherwise(reason)
    for name in reversed(layout.keys):
        reason = F.when(~_filled(name.lower()), F.lit(f"key {name.lower()}")).otherwise(reason)
    reason = F.when(F.col(_BROKEN).isNotNull(), F.lit("cells")).otherwise(reason)
    judged = texts.withColumn("reason", reason)
    cells = [F.col(f"`{c}`") for c in texts.columns if c not in (_BROKEN, "__file")]
    line = F.coalesce(F.col(_BROKEN), F.to_csv(F.struct(*cells), {"sep": layout.sep} | QUOTED))
    good = judged.filter(F.col("reason").isNull()).select(
        *[F.when(_filled(c), F.col(f"`{c}`")).try_cast(kind).alias(c) for c, kind in columns.items()]
    )
    rejected = judged.filter(F.col("reason").isNotNull()).select(F.col("__file").alias("file"), "reason", line.alias("line"))
    return good, rejected
