"""CSV and other delimited files, always with a schema given by the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def text_schema(names: Sequence[str]) -> StructType:
    """All columns as text: the safe schema for wide tables whose values need cleaning first."""
    return StructType([StructField(n, StringType()) for n in names])


#: A separator inside quotes belongs to the value, and a doubled quote there is one quote.
QUOTED = {"quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str) -> DataFrame:
    """Comma file with a header row; a byte-order mark before the header is ignored."""
    return spark.read.schema(schema).options(**QUOTED).option("header", True).csv(paths)


def read_named(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Mapping[str, str],
    sep: str = ",",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Some columns of a wide file, found by the names in its header whatever their case.

    Every file of the read must have the same header: where a named column stands under another name,
    the read fails. Text that does not fit a column's type gives NULL. Only the named columns are parsed.
    """
    reader = spark.read.options(**QUOTED).option("header", True).option("sep", sep).option("encoding", encoding)
    found = reader.csv(paths).schema
    table = reader.schema(found).option("enforceSchema", False).csv(paths)
    table = table.toDF(*[c.strip().lower() for c in table.columns])
    return table.select(*[F.col(f"`{name}`").try_cast(kind).alias(name) for name, kind in columns.items()])


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    names: Sequence[str] | StructType | str,
    sep: str = "|",
    encoding: str = "UTF-8",
    header: bool = False,
) -> DataFrame:
    """Tab, pipe or comma file named by position.

    A list of names gives text columns, so keys keep their leading zeros; a text is a DDL schema. Two-byte encodings need their
    byte order (``UTF-16LE``): with it the file can still be split between tasks.
    """
    schema = names if isinstance(names, (StructType, str)) else text_schema(names)
    reader = (
        spark.read.schema(schema)
        .options(**QUOTED)
        .option("sep", sep)
        .option("header", header)
        .option("encoding", encoding)
        .option("enforceSchema", True)
    )
    if encoding.upper().startswith("UTF-16"):
        reader = reader.option("lineSep", "\n")
    return reader.csv(paths)


def read_tagged(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str,
    tag: str,
    pattern: str = r"(\d{4})",
    tag_type: str = "string",
    header: bool = True,
) -> DataFrame:
    """Many files of one layout stacked in one scan, with a column taken from each file's path.

    Covers both "one file per year" and "one tab per area" (tabs staged as files).
    """
    df = (
        spark.read.schema(schema)
        .options(**QUOTED)
        .option("header", header)
        .option("recursiveFileLookup", True)
        .csv(paths)
    )
    found = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return df.select("*", F.nullif(found, F.lit("")).try_cast(tag_type).alias(tag))


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """New names for the first columns; columns past the list keep theirs."""
    return df.toDF(*names, *df.columns[len(names):])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])
