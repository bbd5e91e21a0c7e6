"""Exact quantiles without collecting a group in one place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, IntegralType

from regiolume.operators.joins import left_join
from regiolume.operators.ranges import BLOCK_ROWS, range_block
from regiolume.session import stage

# Buckets per unit of log1p(|value|): neighbours differ by about half a per mille.
RESOLUTION = 2000
# Pieces that the bucket with the wanted rank is cut into.
PIECES = 4096


def _same(keys: Sequence[str]) -> Column:
    """Join test of a group with its own row on the other side."""
    test = F.lit(True)
    for i, k in enumerate(keys):
        test = test & F.col(k).eqNullSafe(F.col(f"__key_{i}"))
    return test


def exact_quantile(
    df: DataFrame, keys: Sequence[str], value: str, q: float = 0.5, name: str = "median"
) -> DataFrame:
    """Exact quantile per group, interpolated between the two neighbouring ranks.

    Spark's own ``percentile`` holds all distinct values of a group in one buffer. Here equal values
    are counted first, spread by (group, value); a histogram over fixed monotone buckets, at most a
    few ten thousand rows per group, tells which bucket holds the wanted ranks. That bucket is cut again into
    ``PIECES`` of equal width between its own smallest and largest value, and only the values of the wanted
    piece are put in order. Missing values and NaN are left out; a group without values has no row. Whole numbers
    and decimals keep their type, see ``exact_quantiles``.
    """
    keys = list(keys)
    if not isinstance(df.schema[value].dataType, (DoubleType, FloatType)):
        return exact_quantiles(df, keys, value, {name: q})
    v = F.col(value).cast("double")
    counts = (
        df.filter(F.col(value).isNotNull() & ~F.isnan(v))
        .groupBy(*keys, v.alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__b", F.floor(F.signum("__v") * F.log1p(F.abs("__v")) * RESOLUTION))
        # Said here so that both uses below are the same plan and the counts are computed once.
        .filter(F.col("__b").isNotNull())
    )
    rank = (F.col("__size") - 1) * F.lit(float(q))
    by_bucket = Window.partitionBy(*keys).orderBy("__b")
    buckets = counts.groupBy(*keys, "__b").agg(
        F.sum("__n").alias("__pn"), F.min("__v").alias("__least"), F.max("__v").alias("__most")
    )
    buckets = buckets.withColumn("__before", F.sum("__pn").over(by_bucket) - F.col("__pn"))
    buckets = buckets.withColumn("__size", F.sum("__pn").over(Window.partitionBy(*keys)))
    buckets = buckets.withColumn("__lo", F.floor(rank)).withColumn("__hi", F.ceil(rank))
    held = (F.col("__before") <= F.col("__hi")) & (F.col("__before") + F.col("__pn") > F.col("__lo"))
    buckets = buckets.filter(held).select(
        *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)], F.col("__b").alias("__bucket"),
        "__before", "__lo", "__hi", (rank - F.col("__lo")).alias("__f"), "__least", "__most",
    )
    wide = F.col("__most") - F.col("__least")
    piece = F.when(wide > 0, F.floor((F.col("__v") - F.col("__least")) / wide * PIECES)).otherwise(0)
    inner = counts.join(buckets, _same(keys) & (F.col("__b") == F.col("__bucket"))).select(
        *keys, "__b", "__v", "__n", "__before", "__lo", "__hi", "__f", piece.alias("__piece")
    )
    pieces = inner.groupBy(*keys, "__b", "__piece").agg(
        F.sum("__n").alias("__pn"), F.max("__before").alias("__base"), F.max("__lo").alias("__l"), F.max("__hi").alias("__h")
    )
    earlier = F.sum("__pn").over(Window.partitionBy(*keys, "__b").orderBy("__piece")) - F.col("__pn")
    pieces = pieces.withColumn("__start", F.col("__base") + earlier)
    pieces = pieces.filter((F.col("__start") <= F.col("__h")) & (F.col("__start") + F.col("__pn") > F.col("__l"))).select(
        *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
        F.col("__b").alias("__bucket"), F.col("__piece").alias("__part"), "__start",
    )
    same = _same(keys) & (F.col("__b") == F.col("__bucket")) & (F.col("__piece") == F.col("__part"))
    in_piece = Window.partitionBy(*keys, "__b", "__piece").orderBy("__v")
    ranked = inner.join(pieces, same).withColumn("__upto", F.col("__start") + F.sum("__n").over(in_piece))

    def at(rank_name: str):
        r = F.col(rank_name)
        return F.max(F.when((F.col("__upto") - F.col("__n") <= r) & (r < F.col("__upto")), F.col("__v")))

    picked = ranked.groupBy(*keys).agg(
        at("__lo").alias("__vlo"), at("__hi").alias("__vhi"), F.max("__f").alias("__f")
    )
    f = F.col("__f")
    mixed = F.col("__vlo") * (1 - f) + F.col("__vhi") * f
    return picked.select(*keys, mixed.alias(name))


def _as_exact(value: str, kind: DataType) -> Column:
    """A value in the form that is counted and mixed: whole numbers as decimals, everything else as it is."""
    return F.col(value).cast("decimal(20,0)") if isinstance(kind, IntegralType) else F.col(value)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float | str], rows: int = BLOCK_ROWS
) -> DataFrame:
    """Several exact quantiles per group (``{column: q}``) from one scan of the rows, in the type of the value.

    Equal values are counted first, spread by group and value, and the counts are written once. They are cut into blocks of
    neighbouring values, about equally large whatever their distribution; the counts of the blocks tell which few
    hold a wanted rank of any quantile, and only those are put in order.

    The rank (n - 1) q lies between two values: whole numbers and decimals are mixed as decimals, exactly, with as many
    more digits as q has; doubles as doubles; dates, times and texts give the lower value. Missing values and NaN are left
    out; a group without values has no row, and without keys an empty table has one row of NULL.
    """
    keys, kind = list(keys), df.schema[value].dataType
    present = F.col(value).isNotNull()
    if isinstance(kind, (DoubleType, FloatType)):
        present = present & ~F.isnan(value)
    counts = stage(
        df.filter(present).groupBy(*keys, _as_exact(value, kind).alias("__v")).agg(F.count(F.lit(1)).alias("__n")), "counts"
    )
    kind = counts.schema["__v"].dataType
    exact = {name: Decimal(str(q)) for name, q in quantiles.items()}
    digits = max([0, *(-q.as_tuple().exponent for q in exact.values())])
    one = 10**digits
    asked = F.array(*[F.struct(F.lit(name).alias("q"), F.lit(int(q * one)).cast("long").alias("a")) for name, q in exact.items()])

    counts = counts.withColumn("__b", range_block(counts, [*keys, "__v"], rows))
    group = Window.partitionBy(*keys)
    blocks = counts.groupBy(*keys, "__b").agg(F.sum("__n").alias("__bn"))
    blocks = blocks.withColumn("__before", F.sum("__bn").over(group.orderBy("__b")) - F.col("__bn"))
    blocks = blocks.withColumn("__scaled", F.sum("__bn").over(group) - 1).select("*", F.explode(asked).alias("__q"))
    scaled = F.col("__scaled") * F.col("__q.a")
    low, rest = F.expr(f"(__scaled * __q.a) div {one}"), F.pmod(scaled, F.lit(one))
    blocks = blocks.select(
        *keys, "__b", "__bn", "__before", F.struct(
            F.col("__q.q").alias("q"), low.alias("lo"), (low + (rest > 0).cast("long")).alias("hi"), rest.alias("rest")
        ).alias("__rank"),
    )
    held = (F.col("__before") <= F.col("__rank.hi")) & (F.col("__before") + F.col("__bn") > F.col("__rank.lo"))
    wanted = blocks.filter(held).groupBy(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)], F.col("__b").alias("__bucket")).agg(
        F.max("__before").alias("__start"), F.collect_list("__rank").alias("__ranks")
    )
    inner = counts.join(stage(wanted, "ranks"), _same(keys) & (F.col("__b") == F.col("__bucket")))
    ordered = Window.partitionBy(*keys, "__b").orderBy("__v")
    placed = inner.withColumn("__upto", F.col("__start") + F.sum("__n").over(ordered))
    inside = lambda r: (F.col("__upto") - F.col("__n") <= r) & (r < F.col("__upto"))
    found = placed.select(*keys, "__v", "__n", "__upto", F.explode("__ranks").alias("__r")).filter(
        inside(F.col("__r.lo")) | inside(F.col("__r.hi"))
    )

    def at(name: str, rank: str) -> Column:
        return F.max(F.when((F.col("__r.q") == name) & inside(F.col(f"__r.{rank}")), F.col("__v")))

    columns = {}
    for i, name in enumerate(exact):
        columns |= {f"__lo{i}": at(name, "lo"), f"__hi{i}": at(name, "hi"), f"__f{i}": F.max(F.when(F.col("__r.q") == name, F.col("__r.rest")))}
    picked = found.groupBy(*keys).agg(*[c.alias(n) for n, c in columns.items()])

    def mixed(i: int) -> Column:
        lo, hi, rest = F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.col(f"__f{i}")
        if isinstance(kind, DecimalType):
            more = min(digits, 38 - kind.precision)
            part = rest.cast(f"decimal({digits + 1},0)") * F.lit(Decimal(1).scaleb(-digits))
            return (lo + (hi - lo) * part).cast(f"decimal({kind.precision + more},{kind.scale + more})")
        if isinstance(kind, (DoubleType, FloatType)):
            return lo * (1 - rest / one) + hi * (rest / one)
        return lo

    return picked.select(*keys, *[mixed(i).alias(name) for i, name in enumerate(exact)])


def exact_median(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "median", is_strict: bool = False
) -> DataFrame:
    """Median per group. ``is_strict`` gives NULL for a group in which a value is missing."""
    out = exact_quantile(df, keys, value, 0.5, name)
    if not is_strict:
        return out
    gaps = df.groupBy(*keys).agg((F.count(F.lit(1)) - F.count(value)).alias("__missing"))
    both = left_join(gaps, out, list(keys))
    return both.withColumn(name, F.when(F.col("__missing") == 0, F.col(name))).drop("__missing")
