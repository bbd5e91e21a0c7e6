"""Line-numbered text: title rows above a header, and report text laid out in blocks.

Spark gives lines of a file no number. Each line here gets one from the byte offset of its file
split and its place inside the split, so a file of any size stays split between tasks and no text is copied: only
one row per split is aggregated to find where each split starts.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regiolume.functions.text import squeeze
from regiolume.session import stage
from regiolume.sources.delimited import QUOTED, text_schema


#: Splits up to which the table of their first lines is sent to all tasks: some 120 bytes each.
_FEW_SPLITS = 400_000


def numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines as ``(file, pos, line)`` with ``pos`` counted from 0 in each file, read where they are.

    A first scan counts the lines of each split and writes one row per split; the second numbers its lines as it reads them: the
    lines of the splits before it in the file, and its place in its own. No text is copied or moved. Spark could cut the files
    in another way for the second scan (more cores, changed settings); a line that then lies outside its split's count
    fails the job instead of getting a wrong number.
    """
    placed = spark.read.option("recursiveFileLookup", True).text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )
    splits = stage(
        placed.groupBy("file", "split").agg(F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("lines")), "splits"
    )
    before = F.sum("lines").over(Window.partitionBy("file").orderBy("split")) - F.col("lines")
    starts = splits.withColumn("before", before)
    if splits.count() <= _FEW_SPLITS:
        starts = F.broadcast(starts)
    place = F.col("seq") - F.col("first_seq")
    pos = F.when((place >= 0) & (place < F.col("lines")), F.col("before") + place).otherwise(
        F.raise_error(F.lit("the files were cut into other splits than when they were counted; read them again")).cast("long")
    )
    return placed.join(starts, ["file", "split"], "left").select("file", pos.alias("pos"), "line")


def read_header(spark: SparkSession, path: str | Sequence[str], skip: int, sep: str = ",") -> list[str]:
    """Column names on line ``skip`` of a file, fetched as that file's first few lines only.

    Names come in the usual workbook form: blanks become dots, a missing name becomes ``X<n>``.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    top = reader.text(path).select("value").take(skip + 1)
    if len(top) <= skip:
        raise ValueError(f"no header on line {skip}")
    names = next(csv.reader([top[skip].value.lstrip("\ufeff")], delimiter=sep))
    return [".".join(n.split()) or f"X{i + 1}" for i, n in enumerate(names)]


def parse_lines(
    lines: DataFrame, names: Sequence[str] | StructType | str, skip: int, sep: str = ",", keep: Sequence[str] = ()
) -> DataFrame:
    """Rows below the header on line ``skip`` as columns, with ``pos`` counted from 1 below the header.

    Blank rows are dropped but keep their place in the numbering.
    """
    if isinstance(names, str):
        ddl = names
    else:
        fields = names.fields if isinstance(names, StructType) else text_schema(names).fields
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    body = lines.filter(F.col("pos") > skip).filter(
        F.regexp_replace("line", f"[\\s{sep}]", "") != ""
    )
    cells = F.from_csv("line", ddl, {"sep": sep} | QUOTED)
    return body.select("file", (F.col("pos") - skip).alias("pos"), *keep, cells.alias("c")).select(
        "file", "pos", *keep, "c.*"
    )


def read_below_titles(
    spark: SparkSession,
    paths: str | Sequence[str],
    skip: int,
    schema: StructType | str | None = None,
    sep: str = ",",
) -> DataFrame:
    """Table whose header stands below ``skip`` title rows. Without a schema all columns are text
    under the names of the header row."""
    lines = numbered_lines(spark, paths)
    names = schema if schema is not None else read_header(spark, paths, skip, sep)
    return parse_lines(lines, names, skip, sep)


def header_rows(lines: DataFrame, skip: int, sep: str = ",") -> DataFrame:
    """``(file, names)``: the column names on line ``skip`` of every file, in the form of ``read_header``."""
    outside_quotes = re.escape(sep) + r'(?=(?:[^"]*"[^"]*")*[^"]*$)'
    cells = F.split(F.regexp_replace("line", "^\ufeff", ""), outside_quotes, -1)

    def name(cell: Column, at: Column) -> Column:
        plain = F.replace(F.regexp_replace(F.trim(cell), '^"(.*)"$', "$1"), F.lit('""'), F.lit('"'))
        dotted = F.replace(F.trim(squeeze(plain)), F.lit(" "), F.lit("."))
        return F.when(dotted == "", F.concat(F.lit("X"), at + 1)).otherwise(dotted)

    return lines.filter(F.col("pos") == skip).select("file", F.transform(cells, name).alias("names"))


def read_headed(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Mapping[str, str] | None = None,
    skip: int = 0,
    sep: str = ",",
    tag: str | None = None,
    tag_value: Column | None = None,
) -> DataFrame:
    """Files whose headers differ in order or in columns, stacked in one scan: every value comes from where its own file's
    header has the name.

    ``skip`` title rows stand above each header. ``columns`` names the wanted columns with their types, found whatever
    their case; without it all names of all headers are taken, as text. A name that a file lacks is NULL there, of a name that
    a file has twice the first counts, a value that does not fit its type is NULL. ``tag`` adds a column ``tag_value``, an
    expression of ``file``. Rows come with ``file`` and ``pos`` (from 1 below the header); blank rows are left out. A file without
    a header line gives no rows. The headers, one row for each file, are written before the rows are read.
    """
    lines = numbered_lines(spark, paths)
    heads = header_rows(lines, skip, sep)
    if tag is not None:
        heads = heads.withColumn(tag, tag_value)
    heads = stage(heads.withColumn("keys", F.transform("names", F.lower)), "headers")
    width = heads.agg(F.max(F.size("names"))).first()[0] or 1
    if columns is None:
        named = heads.select("file", F.posexplode(F.arrays_zip("names", "keys")).alias("at", "n"))
        found = named.groupBy("n.keys").agg(F.min(F.struct("at", "n.names")).alias("first"))
        columns = {r["first"]["names"]: "string" for r in sorted(found.collect(), key=lambda r: (r["first"]["at"], r["keys"]))}
    ddl = ", ".join(f"c{i} string" for i in range(width))
    body = lines.filter((F.col("pos") > skip) & (F.regexp_replace("line", f"[\\s{re.escape(sep)}]", "") != ""))
    cells = F.from_csv("line", ddl, {"sep": sep} | QUOTED).alias("c")
    rows = body.select("file", (F.col("pos") - skip).alias("pos"), cells).join(heads.drop("names"), "file")
    values = F.array(*[F.col(f"c.c{i}") for i in range(width)])
    rows = rows.select("file", "pos", *([tag] if tag is not None else []), "keys", values.alias("values"))
    # A name without a place gives the place -1, which no array has.
    value = lambda name: F.get("values", F.array_position("keys", F.lit(name.lower())).cast("int") - 1)
    return rows.select(
        "file", "pos", *([tag] if tag is not None else []),
        *[value(name).try_cast(kind).alias(name) for name, kind in columns.items()],
    )


def _bare(path: Column) -> Column:
    """A file's path as it was given: decoded, without scheme."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^[A-Za-z][A-Za-z0-9+.-]*:/+", "/")


def read_tabs(
    spark: SparkSession,
    tabs: dict[str, str],
    skip: int,
    tag: str,
    sep: str = ",",
) -> DataFrame:
    """Workbook tabs staged as files, stacked in one scan, with the tab's name as a column.

    Tabs may differ in their columns and in the order of them: a column one tab lacks is NULL there.
    """
    name = F.lit(None).cast("string")
    for tab, path in tabs.items():
        bare = re.sub("^[A-Za-z][A-Za-z0-9+.-]*:/+", "/", path).rstrip("/")
        inside = F.concat(_bare(F.col("file")), F.lit("/")).contains(bare + "/")
        name = F.when(inside, F.lit(tab)).otherwise(name)
    return read_headed(spark, list(tabs.values()), skip=skip, sep=sep, tag=tag, tag_value=name)


def report_blocks(
    lines: DataFrame,
    first: int,
    last: int | None,
    blocks: Sequence[Sequence[tuple[int, str]]],
    line: str | Column = "line",
) -> DataFrame:
    """Blank-separated report text to columns, side-by-side blocks stacked under each other.

    ``first``/``last`` are line positions, both kept (``last=None``: to the end). Each block is a
    list of ``(field index, column name)``; a field a line does not have is NULL.
    """
    keep = F.col("pos") >= first
    if last is not None:
        keep = keep & (F.col("pos") <= last)
    text = F.ltrim(squeeze(F.replace(line if isinstance(line, Column) else F.col(line), F.lit(","), F.lit(""))))
    cells = lines.filter(keep).select("file", "pos", F.split(text, " ").alias("cell"))
    row = F.explode(
        F.array(*[
            F.struct(F.lit(i).alias("block"), *[F.get("cell", F.lit(at)).alias(name) for at, name in b])
            for i, b in enumerate(blocks)
        ])
    )
    return cells.select("file", "pos", row.alias("r")).select("file", "pos", "r.*")
