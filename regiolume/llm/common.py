"""Rules shared by the operators on documents.

Ids: where an operator compares ids, a NULL id counts as the smallest one (``LEAST_ID``); the row itself
comes back with its NULL. Columns: an operator reads the columns it is told to, so further columns never
disturb it; where it adds columns to its input, they replace input columns of the same name.
"""

from __future__ import annotations

import pathlib
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_ID = -(2**63)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The white space of the contracts, ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\x0c\r"
#: Rows that go to a Python worker at once with their texts: on both sides of the pipe they are held whole.
BATCH_ROWS = 2048
#: Rows of 64 bits in the table that tells which keys may be in another table; it is broadcast and does not grow with the data.
FILTER_ROWS = 1 << 17


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the tasks' Python this package, once for each application, wherever the executors run."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        top = pathlib.Path(__file__).resolve().parents[2]
        folder = tempfile.mkdtemp(prefix="package-")
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/regiolume", "zip", top, "regiolume"))
        _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_or_least(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("long"), F.lit(LEAST_ID))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` is faster and does just that on plain ASCII."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def release(spark: SparkSession) -> None:
    """Let the shuffle files of finished steps go.

    Spark deletes them when the driver's garbage collector finds that no plan needs them any more. A driver that only
    plans collects rarely, so an operator of many steps asks for it after those that moved much.
    """
    spark.sparkContext._jvm.System.gc()


def inner_prefix(df: DataFrame) -> str:
    """What names of inner columns begin with, so that none is a name of the table's."""
    prefix = "__"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def replace_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns; those of the same name go, whatever their case."""
    gone = {name.lower() for name in columns}
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone],
        *[c.alias(name) for name, c in columns.items()],
    )


def may_be_in(df: DataFrame, other: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` with a boolean column: false only where ``other`` does not have the row's key.

    A table of ``64 * FILTER_ROWS`` bits by the hash of the key comes to all rows of ``df``, so that only those that may have a
    partner need to be moved for a join. Every key of ``other`` is marked; of the rest as many as share a bit with one, which
    are all where ``other`` has many times more keys than the table has bits.
    """
    own = inner_prefix(df)
    row, bit, bits = f"{own}row", f"{own}bit", f"{own}bits"

    def placed(rows: DataFrame) -> DataFrame:
        place = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(64 * FILTER_ROWS))
        return rows.withColumn(row, F.shiftright(place, 6)).withColumn(bit, place.bitwiseAND(F.lit(63)).cast("int"))

    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(bit))
    table = placed(other.select(F.col(f"`{key}`"))).groupBy(row).agg(F.bit_or(one).alias(bits))
    found = placed(df).join(F.broadcast(table), row, "left")
    hit = F.coalesce(F.bit_get(bits, F.col(bit)) == 1, F.lit(False))
    return found.select(*[F.col(f"`{c}`") for c in df.columns], hit.alias(name))
