"""Blocks of long series, nearest values, typed quantiles, fan-out of joins, balanced lines: against plain Python."""

import datetime
import itertools
import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from regiolume.functions import text
from regiolume.operators import joins, nearest, quantile, ranges, series


def orders_of(kind, n, r):
    """Orders of one kind, some sparse, some repeated."""
    if kind == "text":
        return ["".join(r.choice("abcÄé ") for _ in range(r.randrange(1, 8))) + str(k) for k in range(n)]
    if kind == "sparse":
        return [int(1.5 ** (k % 60)) * 1000 + k for k in range(n)]
    if kind == "date":
        return [datetime.date(2000, 1, 1) + datetime.timedelta(days=k) for k in range(n)]
    return list(range(n))


TYPES = {"text": "string", "sparse": "long", "date": "date", "dense": "int"}


@pytest.mark.parametrize("kind", TYPES)
def test_blocks_are_balanced_and_in_order(spark, kind):
    r = random.Random(1)
    keys = orders_of(kind, 3000, r)
    df = spark.createDataFrame([(k,) for k in r.sample(keys, len(keys))] + [(None,)], f"o {TYPES[kind]}")
    got = df.withColumn("b", ranges.range_block(df, ["o"], rows=200)).collect()
    order = sorted(got, key=lambda x: (x.o is not None, x.o.encode() if kind == "text" and x.o else x.o or 0) if x.o is not None else (False, 0))
    assert [x.b for x in order] == sorted(x.b for x in got)
    sizes = Counter(x.b for x in got)
    assert len(sizes) >= 10 and max(sizes.values()) <= 3 * 3000 / len(sizes)


def test_small_tables_are_one_block(spark):
    for some in ([], [(1,)], [(None,)], [(1,)] * 900):
        df = spark.createDataFrame(some, "o int")
        assert {x.b for x in df.select(ranges.range_block(df, ["o"], rows=100).alias("b")).collect()} <= {0, 1}


@pytest.mark.parametrize("kind", TYPES)
def test_fill_and_previous_over_blocks(spark, kind):
    r = random.Random(2)
    data = [(s, o, r.choice([None] * 40 + ["x", "y"]), r.choice([None, 1, 2])) for s in ("a", "b", None) for o in orders_of(kind, 700, r)]
    df = spark.createDataFrame(r.sample(data, len(data)), f"s string, o {TYPES[kind]}, label string, v int")
    want_fill, want_prev = set(), set()
    for s in ("a", "b", None):
        mine = sorted((x for x in data if x[0] == s), key=lambda x: x[1].encode() if kind == "text" else x[1])
        label, before = None, None
        for _, o, own, v in mine:
            label = own if own is not None else label
            want_fill.add((s, o, label, v))
            want_prev.add((s, o, own, v, before))
            before = v
    filled = ranges.fill_forward(df, "label", "o", ["s"], rows=90)
    assert filled.columns == df.columns and {tuple(x) for x in filled.collect()} == want_fill
    prev = ranges.previous_value(df, "v", "o", ["s"], "before", rows=90)
    assert {tuple(x) for x in prev.collect()} == want_prev
    assert {tuple(x) for x in series.forward_fill(df, "label", "o", ["s"]).collect()} == want_fill


def test_long_series_need_no_single_task(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5000).alias("o"), (F.col("id") % 13).cast("double").alias("v"))
    out = series.delta_prev(df, "v", [], "o", block_rows=250)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1  # the blocks' own rows, one each
    spread = out.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(spread) >= 3
    values = {x.o: x.v for x in df.collect()}
    assert {x.o: x.delta for x in out.collect()} == {o: values[o] - values[o - 1] if o else None for o in values}
    short = series.delta_prev(df, "v", [], "o")
    assert rows(out) == rows(short)


def test_same_month_and_target_over_blocks(spark):
    days = [datetime.date(2019, 1, 1) + datetime.timedelta(days=3 * k) for k in range(400)]
    df = spark.createDataFrame([("a", d, float(k * k % 101)) for k, d in enumerate(days)], "s string, day date, v double")
    for extra in ({}, {"month": 5}):
        a = series.delta_same_month(df, "v", ["s"], "day", **extra)
        assert rows(series.delta_same_month(df, "v", ["s"], "day", **extra, block_rows=30)) == rows(a)
    assert rows(series.delta_target(df, "v", ["s"], "day", days[50], block_rows=30)) == rows(series.delta_target(df, "v", ["s"], "day", days[50]))


# ---------------------------------------------------------------- quantiles


def quantile_by_hand(values, q):
    values, rank = sorted(values), (len(values) - 1) * Decimal(str(q))
    lo = int(rank)
    hi = lo + (rank > lo)
    return values[lo] + (values[hi] - values[lo]) * (rank - lo)


@pytest.mark.parametrize("kind", ["decimal(18,2)", "long", "decimal(30,6)"])
@pytest.mark.parametrize("block_rows", [7, 100_000])
def test_quantiles_keep_their_type(spark, kind, block_rows):
    r = random.Random(3)
    big = 2**53
    make = (lambda: r.randrange(-50, 50) + big) if kind == "long" else (lambda: Decimal(r.randrange(-10_000, 10_000)) / 100)
    data = [(r.choice(["a", "b", None]), make() if r.random() > 0.1 else None) for _ in range(400)] + [("one", make()), ("none", None)]
    df = spark.createDataFrame(data, f"k string, v {kind}")
    asked = {"q1": 0.25, "median": 0.5, "q9": "0.9", "least": 0, "most": 1}
    got = {x.k: x for x in quantile.exact_quantiles(df, ["k"], "v", asked, rows=block_rows).collect()}
    held = defaultdict(list)
    for k, v in data:
        if v is not None:
            held[k].append(Decimal(v))
    assert set(got) == set(held)
    for k, values in held.items():
        for name, q in asked.items():
            assert isinstance(got[k][name], Decimal) and got[k][name] == quantile_by_hand(values, q)
    one = {x.k: x.median for x in quantile.exact_median(df, ["k"], "v").collect()}
    assert one == {k: quantile_by_hand(v, 0.5) for k, v in held.items()}


def test_quantiles_of_other_types(spark):
    days = [datetime.date(2020, 1, d) for d in (1, 5, 9, 20)]
    df = spark.createDataFrame([(d, float(d.day) if d.day != 9 else float("nan"), f"t{d.day:02}") for d in days], "d date, x double, t string")
    assert quantile.exact_quantiles(df, [], "d", {"m": 0.5}).first().m == days[1]
    assert quantile.exact_quantiles(df, [], "t", {"m": 0.5}).first().m == "t05"
    assert quantile.exact_quantiles(df, [], "x", {"m": 0.5, "q": 0.75}).first() == (5.0, 12.5)
    assert quantile.exact_quantiles(df.limit(0), [], "x", {"m": 0.5}).collect() == [(None,)]


def test_one_scan_for_all_quantiles(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    seen = spark.sparkContext.accumulator(0)  # rows that leave the source
    counted = df.rdd.map(lambda x: (seen.add(1), x)[1]).toDF("k long, id long")
    quantile.exact_quantiles(counted, ["k"], "id", {f"q{i}": i / 10 for i in range(11)}, rows=50).collect()
    assert seen.value == 1000


# ------------------------------------------------------------------ nearest


@pytest.mark.parametrize("block_rows", [5, 100_000])
def test_nearest(spark, block_rows):
    r = random.Random(4)
    values = [(r.choice(["a", "b", None]), p, r.choice([None, float("nan")] + [float(x) for x in range(0, 60, 3)])) for p in range(60)]
    values += [("alone", 900, 5.0), ("twins", 901, 5.0), ("twins", 902, 5.0)]
    targets = [(r.choice(["a", "b", None, "nobody"]), t, r.choice([None] + [x / 2 for x in range(-4, 140)])) for t in range(40)]
    a = spark.createDataFrame(values, "k string, p int, v double")
    b = spark.createDataFrame(targets, "k string, t int, v double")
    good = [x for x in values if x[2] is not None and x[2] == x[2]]
    want = set()
    for k, t, v in targets:
        far = [(abs(x[2] - v), x) for x in good if x[0] == k] if v is not None else []
        want |= {(k, t, v, x[1], x[2], d) for d, x in far if d == min(far)[0]}
    got = nearest.nearest_rows(a, b, "v", ["k"], rows=block_rows)
    assert got.columns == ["k", "t", "v", "near_p", "near_v", "diff"] and {tuple(x) for x in got.collect()} == want
    want = set()
    for k, p, v in good:
        far = [(abs(x[2] - v), x) for x in good if x[0] == k and x[1] != p]
        want |= {(k, p, v, x[1], x[2], d) for d, x in far if d == min(d for d, _ in far)}
    assert {tuple(x) for x in nearest.nearest_other(a, "v", "p", ["k"], rows=block_rows).collect()} == want
    assert nearest.nearest_rows(a.limit(0), b, "v", ["k"]).count() == 0


# ------------------------------------------------------------------ fan-out


def test_fan_out_is_what_the_join_gives(spark):
    r = random.Random(5)
    make = lambda n, names: [(r.choice([None, "hot", "hot", "hot", "a", "b"]), r.choice([1, None]), names + str(i)) for i in range(n)]
    left = spark.createDataFrame(make(90, "l") + [("lonely", 1, "l")], "x string, y int, l string")
    right = spark.createDataFrame(make(70, "r"), "u string, y int, r string")
    on = {"x": "u", "y": "y"}
    for match in (True, False):
        told = joins.predict_join(left, right, on, match).first()
        joined = joins.left_join(left, right, on, null_keys_match=match)
        assert told.left_join_rows == joined.count() and told.unmatched_left == joined.filter("r is null").count()
        assert told.inner_rows == joined.filter("r is not null").count() and (told.left_rows, told.right_rows) == (91, 70)
        worst = joins.worst_keys(left, right, on, 3, match).collect()
        made = Counter((x.x, x.y) for x in joined.filter("r is not null").collect())
        assert [w.joined_rows for w in worst] == [n for _, n in made.most_common(3)] and told.largest == worst[0].joined_rows
        assert all(made[w.x, w.y] == w.joined_rows for w in worst)
    with pytest.raises(ValueError, match="worst keys.*hot"):
        joins.assert_fan_out(left, right, on)
    assert joins.assert_fan_out(left, right.dropDuplicates(["u", "y"]), on) is left
    assert joins.predict_join(left.limit(0), right.limit(0), on).first().left_join_rows == 0


# --------------------------------------------------------------- lines


def balanced_by_hand(label, width):
    words = label.split()
    if not words:
        return ""
    best = None
    for breaks in itertools.product([False, True], repeat=len(words) - 1):
        starts = [0] + [i + 1 for i, b in enumerate(breaks) if b]
        lines = [" ".join(words[a:b]) for a, b in zip(starts, starts[1:] + [len(words)], strict=True)]
        if any(len(x) > width and " " in x for x in lines):
            continue
        cost = sum(max(0, width - len(x)) ** 2 for x in lines[:-1])
        choice = (cost, len(lines), starts[::-1], "\n".join(lines))
        best = choice if best is None or choice < best else best
    return best[3]


def test_balanced_lines(spark):
    r = random.Random(6)
    labels = [" ".join("w" * r.randrange(1, 9) for _ in range(r.randrange(1, 9))) for _ in range(60)]
    labels += ["", "  two   blanks ", "averyveryverylongword short", "aaa bb cc ddddd", "Größe für Zürich"]
    df = spark.createDataFrame([(x,) for x in labels] + [(None,)], "c string")
    for width in (1, 6, 10, 25):
        got = {x.c: x.b for x in df.select("c", text.wrap_balanced("c", width).alias("b")).collect()}
        assert got.pop(None) is None
        assert got == {x: balanced_by_hand(x, width) for x in labels}
    # Greedy lines leave a short last line before a long one; even lines do not.
    assert balanced_by_hand("aaa bb cc ddddd", 6) == "aaa\nbb cc\nddddd"


@pytest.mark.parametrize("block_rows", [1, 7, 1000])
def test_blocks_without_series(spark, block_rows):
    """A long file without series: blocks hand on what was filled, also over blocks that hold nothing; no window over the file."""
    values = [None, None, "a", None, "b"] + [None] * 30 + ["c", None, "d"] + [None] * 5
    df = spark.createDataFrame([(i * 3, v) for i, v in enumerate(values)], "o int, v string").repartition(3)
    filled, last = [], None
    for v in values:
        last = v or last
        filled.append(last)
    got = ranges.fill_forward(df, "v", "o", rows=block_rows)
    assert [r.v for r in got.orderBy("o").collect()] == filled
    before = ranges.previous_value(df, "v", "o", name="before", rows=block_rows)
    assert [r.before for r in before.orderBy("o").collect()] == [None, *values[:-1]]
    for plan in (x._jdf.queryExecution().executedPlan().toString() for x in (got, before)):
        assert not re.search(r"Sort [^\n]*\n[^\n]*Exchange SinglePartition", plan)
