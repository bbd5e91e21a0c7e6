"""Left equi-joins and their guards.

No join here forces a broadcast: Spark compares a side's size with
``spark.sql.autoBroadcastJoinThreshold`` when it plans and again at run time, and falls back to a
sort-merge join with skew splitting.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiolume.session import stage
from regiolume.sources.tables import inline_lookup


def _pairs(on: str | Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, Mapping) else {k: k for k in on}


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    defaults: Mapping[str, Any] | None = None,
    null_keys_match: bool = True,
) -> DataFrame:
    """Left join on equal keys (``{left name: right name}`` when they differ).

    A missing key matches a missing key unless ``null_keys_match`` is off. The right side's keys are
    dropped; ``defaults`` fills columns of the right side that are missing after the join.
    """
    pairs = _pairs(on)
    extra = [c for c in right.columns if c not in pairs.values()]
    clash = sorted(set(extra) & set(left.columns))
    if clash:
        raise ValueError(f"both sides have {clash}; rename them or use left_join_suffixed")
    keys = {a: f"__key_{i}" for i, a in enumerate(pairs)}
    side = right.select(
        *[F.col(f"`{b}`").alias(keys[a]) for a, b in pairs.items()], *[F.col(f"`{c}`") for c in extra]
    )
    test = F.lit(True)
    for a, k in keys.items():
        same = F.col(f"`{a}`").eqNullSafe(F.col(k)) if null_keys_match else F.col(f"`{a}`") == F.col(k)
        test = test & same
    out = left.join(side, test, "left").drop(*keys.values())
    for name, value in (defaults or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return out


def sized(df: DataFrame) -> DataFrame:
    """An aggregated side written to the shared folder and read back.

    Before an aggregate has run Spark only knows the size of its input, so joining it to its own
    facts would shuffle them. A written table has a known size: Spark broadcasts it when it is below
    the threshold and sorts and merges when it is not. Runs the aggregate once, now.
    """
    return stage(df, "side")


def with_totals(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column]) -> DataFrame:
    """Every row next to aggregates of its group.

    A window would move each group into one task. The aggregates combine on the map side, and while
    they are small the rows are not moved at all.
    """
    totals = df.groupBy(*keys).agg(*[c.alias(name) for name, c in aggregates.items()])
    return left_join(df, sized(totals), list(keys))


def left_join_suffixed(
    left: DataFrame, right: DataFrame, on: Sequence[str], suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    """Left join where columns both sides have (apart from the keys) get a suffix."""
    clash = (set(left.columns) & set(right.columns)) - set(on)
    a = left.toDF(*[c + suffixes[0] if c in clash else c for c in left.columns])
    b = right.toDF(*[c + suffixes[1] if c in clash else c for c in right.columns])
    return left_join(a, b, on)


def lookup(
    df: DataFrame, table: Mapping[str, Any], c: str, into: str, default: Any = None
) -> DataFrame:
    """Recode a column by an in-program table; unmatched values give ``default``.

    The table is a local relation, so Spark knows its size and decides about a broadcast by itself.
    """
    if not table:
        return df.withColumn(into, F.lit(default))
    side = inline_lookup(df.sparkSession, table, "__from", "__to")
    out = df.join(side, F.col(c) == F.col("__from"), "left")
    found = F.col("__to") if default is None else F.coalesce(F.col("__to"), F.lit(default))
    return out.withColumn(into, found).drop("__from", "__to")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count: what a join on them would fan out."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def key_counts(
    left: DataFrame, right: DataFrame, on: str | Sequence[str] | Mapping[str, str], null_keys_match: bool = True
) -> DataFrame:
    """Each key of either side (by the left side's names) with ``left_rows``, ``right_rows`` and ``joined_rows``, what an
    inner join makes of it.

    Only keys and counts are joined, after each side has been counted in its map tasks: a key that holds a third of all
    rows is one row here.
    """
    pairs = _pairs(on)
    names = [f"__key_{i}" for i in range(len(pairs))]

    def counted(df: DataFrame, keys, name: str) -> DataFrame:
        return df.groupBy(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)]).agg(
            F.count(F.lit(1)).alias("__n")
        ).withColumn("__side", F.lit(name))

    both = counted(left, pairs.keys(), "left").unionByName(counted(right, pairs.values(), "right"))
    side = lambda name: F.coalesce(F.sum(F.when(F.col("__side") == name, F.col("__n"))), F.lit(0)).alias(f"{name}_rows")
    counts = both.groupBy(*names).agg(side("left"), side("right"))
    joined = F.col("left_rows").cast("decimal(38,0)") * F.col("right_rows")
    if not null_keys_match:
        filled = F.lit(True)
        for n in names:
            filled = filled & F.col(n).isNotNull()
        joined = F.when(filled, joined).otherwise(0)
    return counts.select(*[F.col(n).alias(k) for n, k in zip(names, pairs, strict=True)], "left_rows", "right_rows", joined.cast("decimal(38,0)").alias("joined_rows"))


def predict_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str] | Mapping[str, str], null_keys_match: bool = True
) -> DataFrame:
    """One row that tells, before a join runs, what it will give: ``left_rows, right_rows, inner_rows, left_join_rows``,
    ``unmatched_left`` rows, the ``keys`` that fan out and the ``largest`` number of rows one key makes."""
    counts = key_counts(left, right, on, null_keys_match)
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,0)").alias(name)
    alone = F.when(F.col("joined_rows") == 0, F.col("left_rows")).otherwise(0)
    return counts.agg(
        total(F.col("left_rows"), "left_rows"), total(F.col("right_rows"), "right_rows"), total(F.col("joined_rows"), "inner_rows"),
        total(F.col("joined_rows") + alone, "left_join_rows"), total(alone, "unmatched_left"),
        F.count_if((F.col("joined_rows") > F.col("left_rows"))).alias("keys"),
        F.coalesce(F.max("joined_rows"), F.lit(0)).cast("decimal(38,0)").alias("largest"),
    )


def worst_keys(
    left: DataFrame, right: DataFrame, on: str | Sequence[str] | Mapping[str, str], n: int = 20, null_keys_match: bool = True
) -> DataFrame:
    """The ``n`` keys that make the most rows in a join, with the counts of both sides."""
    keys = list(_pairs(on))
    counts = key_counts(left, right, on, null_keys_match).filter("joined_rows > 0")
    return counts.orderBy(F.desc("joined_rows"), *[F.asc_nulls_first(F.col(f"`{k}`")) for k in keys]).limit(n)


def assert_fan_out(
    left: DataFrame, right: DataFrame, on: str | Sequence[str] | Mapping[str, str], most: float = 1.0, null_keys_match: bool = True
) -> DataFrame:
    """The left table, or an error with the worst keys if a left join would make more than ``most`` rows of each of
    its rows on average. Runs the two counts, not the join."""
    found = predict_join(left, right, on, null_keys_match).first()
    if found["left_join_rows"] > most * float(found["left_rows"]):
        worst = [tuple(r) for r in worst_keys(left, right, on, 5, null_keys_match).collect()]
        raise ValueError(f"{found['left_rows']} rows become {found['left_join_rows']}; the worst keys (left, right, joined rows): {worst}")
    return left


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table itself, or an error naming one repeated key. Runs one aggregation."""
    hit = duplicate_keys(df, keys).first()
    if hit is not None:
        raise ValueError(f"key {tuple(hit)[:-1]} occurs {hit['rows']} times")
    return df
