import random
import statistics
from datetime import date

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regiolume.operators import aggregate, filters, joins, project, quantile, reshape, series, setops, topk, totals
from regiolume.operators.series import Event

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# Projections and filters -----------------------------------------------------------------------


def test_names_by_pattern_and_position(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["a.x", "b_x", "a_y", "b"])
    assert project.select_like(df, "^a").columns == ["a.x", "a_y"]
    assert project.drop_like(df, r"\.").columns == ["b_x", "a_y", "b"]
    assert project.select_positions(df, 2, 3).columns == ["b_x", "a_y"]
    assert project.drop_columns(df, ["a.x", "b"]).columns == ["b_x", "a_y"]


def test_measure_must_be_allowed(spark):
    df = spark.createDataFrame([(1, 2)], ["k", "m"])
    assert rows(project.select_metric(df, ["k"], "m", ["m"])) == [(1, 2)]
    with pytest.raises(ValueError):
        project.select_metric(df, ["k"], "secret", ["m"])
    with pytest.raises(ValueError):
        filters.where_equal(df, ["k"], m=1)


def test_exclude_pairs_keeps_missing_values(spark):
    df = spark.createDataFrame([("A", "1"), ("A", "2"), ("B", "1"), (None, "1")], "a string, b string")
    assert rows(filters.exclude_pairs(df, "a", "b", [("A", "1")])) == [(None, "1"), ("A", "2"), ("B", "1")]


def test_drop_any_null_with_dotted_names(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (3, None)], "`a.b` int, c string")
    assert rows(filters.drop_any_null(df)) == [(1, "x")]


def test_rows_at_extreme_keep_ties(spark):
    df = spark.createDataFrame([("a", 3), ("b", 3), ("c", 1), ("d", None)], "k string, v int")
    assert rows(filters.at_extreme(df, "v")) == [("a", 3), ("b", 3)]
    assert rows(filters.at_extreme(df, "v", "min")) == [("c", 1)]


def test_year_to_date_trims_all_years(spark):
    days = [date(2019, 3, 1), date(2019, 12, 1), date(2020, 2, 1), date(2021, 1, 1), date(2021, 3, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in rows(filters.year_to_date(df, "d", 2019))] == [days[0], days[2], days[3], days[4]]


def test_clip_keeps_both_bounds(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (2.0,), (2.1,), (None,)], "r double")
    assert rows(filters.clip_rows(df, "r", 0.1, 2)) == [(0.1,), (2.0,)]


# Joins -----------------------------------------------------------------------------------------


def test_missing_keys_match_unless_told_otherwise(spark):
    a = spark.createDataFrame([("x", 1), (None, 2), ("z", 3)], "k string, v int")
    b = spark.createDataFrame([("x", 10), (None, 20)], "key string, w int")
    assert rows(joins.left_join(a, b, {"k": "key"}), "v", "w") == [(1, 10), (2, 20), (3, None)]
    assert rows(joins.left_join(a, b, {"k": "key"}, null_keys_match=False), "v", "w") == [(1, 10), (2, None), (3, None)]
    assert rows(joins.left_join(a, b, {"k": "key"}, defaults={"w": 0}), "v", "w") == [(1, 10), (2, 20), (3, 0)]


def test_join_fans_out_and_the_guard_sees_it(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([("x", 10), ("x", 11)], "k string, w int")
    assert joins.left_join(a, b, "k").count() == 2
    assert rows(joins.duplicate_keys(b, ["k"])) == [("x", 2)]
    with pytest.raises(ValueError, match="occurs 2 times"):
        joins.assert_unique(b, ["k"])
    assert joins.assert_unique(a, ["k"]) is a


def test_name_clashes(spark):
    a = spark.createDataFrame([(1, 2)], ["k", "v"])
    b = spark.createDataFrame([(1, 3)], ["k", "v"])
    with pytest.raises(ValueError):
        joins.left_join(a, b, "k")
    assert joins.left_join_suffixed(a, b, ["k"]).columns == ["k", "v_x", "v_y"]


def test_lookup(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert rows(joins.lookup(df, {"a": "A", "q": "Q"}, "c", "to")) == [(None, None), ("a", "A"), ("b", None)]
    assert rows(joins.lookup(df, {"a": "A"}, "c", "to", default="?")) == [(None, "?"), ("a", "A"), ("b", "?")]


# Aggregates ------------------------------------------------------------------------------------


def test_strict_sum(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("b", None), (None, 4)], "k string, v int")
    assert rows(aggregate.sum_rest(df, ["k"])) == [(None, 4), ("a", 3), ("b", None)]
    assert rows(aggregate.sum_rest(df, ["k"], is_strict=False)) == [(None, 4), ("a", 3), ("b", 3)]


def test_count_filled_leaves_missing_keys_out(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "k string, v int")
    assert rows(aggregate.count_filled(df, ["k"], "v", "n")) == [("a", 1)]


def test_share_rounds_the_operands_first(spark):
    df = spark.createDataFrame([("a", "x", 1.4), ("a", "y", 1.4)], "k string, p string, v double")
    out = aggregate.share_within(df, ["k"], ["p"], F.col("v"), digits=0)
    assert rows(out) == [("a", "x", 1.0, 3.0, 1 / 3), ("a", "y", 1.0, 3.0, 1 / 3)]


@FEW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("pqr"), st.integers(1, 50)), min_size=1, max_size=30))
def test_shares_add_up_to_one(spark, data):
    df = spark.createDataFrame(data, "k string, p string, v int")
    out = aggregate.share_within(df, ["k"], ["p"], F.col("v"))
    for total in out.groupBy("k").agg(F.sum("share").alias("s")).collect():
        assert total.s == pytest.approx(1.0)
    back = joins.with_totals(df, ["k"], {"t": F.sum("v")})
    assert back.count() == len(data) and {(r.k, r.t) for r in back.collect()} == {
        (k, sum(v for kk, _, v in data if kk == k)) for k, _, _ in data
    }


@FEW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from([None, "p", "q"]), st.integers(0, 3)), max_size=30))
def test_unique_rows_are_those_seen_once(spark, data):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, a string, b string, c int")
    want = [(i, *r) for i, r in enumerate(data) if data.count(r) == 1]
    assert rows(aggregate.unique_rows(df, ["a", "b", "c"])) == sorted(want)


@FEW
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.one_of(st.none(), st.floats(-1e6, 1e9))), max_size=40), st.sampled_from([0.0, 0.25, 0.5, 1.0]))
def test_exact_quantile(spark, data, q):
    df = spark.createDataFrame(data, "k string, v double")
    got = {r[0]: r[1] for r in quantile.exact_quantile(df, ["k"], "v", q).collect()}
    groups = {k: sorted(v for kk, v in data if kk == k and v is not None) for k, _ in data}
    groups = {k: v for k, v in groups.items() if v}
    assert got.keys() == groups.keys()
    for k, vs in groups.items():
        at = (len(vs) - 1) * q
        low = int(at)
        want = vs[low] + (vs[min(low + 1, len(vs) - 1)] - vs[low]) * (at - low)
        assert got[k] == pytest.approx(want, rel=1e-12, abs=1e-9)


def test_median_of_a_hot_group(spark):
    """One key holds a third of all rows; equal values and tiny differences must not blur the ranks."""
    rng = random.Random(1)
    data = [("hot", rng.choice([1.0, 1.00001, 5e6, rng.gauss(0, 1)])) for _ in range(4000)]
    data += [(f"k{i % 97}", rng.expovariate(1e-5)) for i in range(8000)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r[0]: r[1] for r in quantile.exact_median(df, ["k"], "v").collect()}
    for k in got:
        assert got[k] == pytest.approx(statistics.median(v for kk, v in data if kk == k), rel=1e-12)


def test_strict_median(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 4.0), ("c", None)], "k string, v double")
    assert rows(quantile.exact_median(df, ["k"], "v")) == [("a", 1.0), ("b", 3.0)]
    assert rows(quantile.exact_median(df, ["k"], "v", is_strict=True)) == [("a", None), ("b", 3.0), ("c", None)]


def test_metric_rows(spark):
    df = spark.createDataFrame([(1, 2.0), (3, 4.0)], "a int, b double")
    assert rows(aggregate.scalars(df, {"n": F.count("*"), "top": F.max("b")})) == [("n", 2.0), ("top", 4.0)]


# Totals ----------------------------------------------------------------------------------------


def test_total_rows_are_told_from_missing_categories(spark):
    df = spark.createDataFrame([(1, "m", 2), (1, None, 3), (2, "m", None)], "y int, d string, v int")
    assert rows(totals.add_total(df, ["y"], "d", ["v"])) == [
        (1, None, 3), (1, "Total", 5), (1, "m", 2), (2, "Total", None), (2, "m", None)
    ]


def test_region_is_the_sum_of_its_members(spark):
    df = spark.createDataFrame([("A", 1, 5), ("B", 1, 7), ("State", 1, 99), (None, 1, 1)], "g string, y int, v int")
    out = {r[0]: r[2] for r in totals.add_region(df, "g", ["y"], ["v"], outside=["State"]).collect()}
    assert out == {"A": 5, "B": 7, "State": 99, None: 1, "Region": 13}


def test_region_levels_are_summed_apart(spark):
    df = spark.createDataFrame([(1, "K", 1, 10), (1, "P", 1, 5), (2, "K", 1, 4), (4, "S", 1, 3)], "l int, p string, y int, v int")
    out = rows(totals.add_region_levels(df, "l", "p", ["y"], ["v"], {1: "Region", 2: "Unincorporated"}))
    assert out == [(1, "K", 1, 10), (1, "P", 1, 5), (1, "Region", 1, 15), (2, "K", 1, 4), (2, "Unincorporated", 1, 4), (4, "S", 1, 3)]


def test_merge_buckets(spark):
    df = spark.createDataFrame([("19-21", 1), ("22-24", 2), ("25-34", 5)], "a string, v int")
    assert rows(totals.merge_buckets(df, "a", [], ["v"], {"18-24": ["19-21", "22-24"]})) == [
        ("18-24", 3), ("19-21", 1), ("22-24", 2), ("25-34", 5)
    ]
    assert rows(totals.merge_buckets(df, "a", [], ["v"], {"18-24": ["19-21", "22-24"]}, keep_parts=False)) == [
        ("18-24", 3), ("25-34", 5)
    ]


def test_residual_needs_a_total_and_all_parts(spark):
    df = spark.createDataFrame(
        [(1, "All", 10), (1, "a", 3), (1, "b", 4), (2, "a", 3), (3, "All", 9), (3, "a", None)], "y int, c string, v int"
    )
    assert rows(totals.residual_rows(df, "c", ["y"], "v", "All", ["a", "b"], "Other")) == [(1, "Other", 3), (3, "Other", None)]


# Series ----------------------------------------------------------------------------------------


def test_delta_stays_inside_its_series_and_telescopes(spark):
    df = spark.createDataFrame([("a", y, float(y * y)) for y in range(5)] + [("b", 3, 7.0)], "s string, y int, v double")
    out = series.delta_prev(df, "v", ["s"], "y")
    first = {(r.s, r.y): r.delta for r in out.collect()}
    assert first[("a", 0)] is None and first[("b", 3)] is None
    assert sum(d for (s, y), d in first.items() if s == "a" and y) == 16.0
    kept = series.delta_target(df, "v", ["s"], "y", 4).filter("delta is not null")
    assert rows(kept, "s", "y", "delta") == [("a", 4, 7.0)]


def test_same_month_delta(spark):
    df = spark.createDataFrame([("a", date(y, m, 1), float(y * m)) for y in (2019, 2020, 2021) for m in (1, 7)], "s string, d date, v double")
    out = rows(series.delta_same_month(df, "v", ["s"], "d", 7), "d", "delta")
    assert out == [(date(2019, 7, 1), None), (date(2020, 7, 1), 7.0), (date(2021, 7, 1), 7.0)]


def test_nearest_period_keeps_ties(spark):
    df = spark.createDataFrame([(2011, 90.0), (2012, 110.0), (2013, 150.0)], "y int, v double")
    assert rows(series.nearest_period(df, "v", F.lit(100.0)), "y") == [(2011,), (2012,)]
    keyed = df.withColumn("k", F.col("y") % 2)
    assert rows(series.nearest_period(keyed, "v", F.lit(100.0), ["k"]), "k", "y") == [(0, 2012), (1, 2011)]


def test_compare_periods(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 15.0), ("b", 1, 0.0), ("b", 2, 5.0)], "k string, p int, v double")
    out = series.compare_periods(df, ["k"], F.col("p"), F.col("v"), {"old": 1, "new": 2})
    assert rows(out) == [("a", 10.0, 15.0, 5.0, 50.0, 1.5), ("b", 0.0, 5.0, 5.0, None, None)]


@FEW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from([None, None, "x", "y"])), max_size=40), st.sampled_from([1, 3, 100]))
def test_forward_fill_in_blocks_equals_the_plain_fill(spark, data, size):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, s string, c string")
    last, want = {}, []
    for i, (s, c) in enumerate(data):
        last[s] = c or last.get(s)
        want.append((i, s, last[s]))
    assert rows(series.forward_fill(df, "c", "i", ["s"], block=F.floor(F.col("i") / size))) == want
    assert rows(series.forward_fill(df, "c", "i", ["s"])) == want


def test_forward_fill_of_a_whole_file_in_blocks(spark):
    df = spark.createDataFrame([(i, "v%d" % i if i % 17 == 5 else None) for i in range(200)], "i int, c string")
    got = rows(series.forward_fill(df, "c", "i", block=F.floor(F.col("i") / 10)))
    assert got[4] == (4, None) and got[5] == (5, "v5") and got[21] == (21, "v5") and got[199] == (199, "v192")


QUARTERS = [date(y, m, 1) for y in (2000, 2001, 2002) for m in (1, 4, 7, 10)]


def test_recession_curve_and_return(spark):
    levels = [100.0, 102.0, 95.0, 93.0, 97.0, 101.0, 104.0, 110.0, 90.0, 95.0, 110.0, 120.0]
    df = spark.createDataFrame(list(zip(QUARTERS, levels)), "q date, v double")
    events = [
        Event("open", "2000-04-01"), Event("with", "2000-04-01", with_peak=True),
        Event("dated", "2000-04-01", end="2001-01-01", below_peak=False),
    ]
    out = series.event_curves(df, [], "q", "v", events, level_digits=0)
    by = {}
    for r in sorted(out.collect(), key=lambda r: (r["event"], r["index"])):
        by.setdefault(r.event, []).append(r.v)
    assert by["open"] == [95.0, 93.0, 97.0, 101.0, 90.0, 95.0]
    assert by["with"] == [102.0, *by["open"]]
    assert by["dated"] == [95.0, 93.0, 97.0]
    sane = series.return_to_peak(df, [], "q", "v", events[:1], level_digits=0).collect()[0]
    assert (sane.returned, sane.years) == (date(2001, 7, 1), 1.2)
    legacy = series.return_to_peak(df, [], "q", "v", events[:1], level_digits=0, legacy=True).collect()[0]
    assert (legacy.returned, legacy.years) == (date(2000, 4, 1), 0.0)


def test_class_growth_and_latest(spark):
    df = spark.createDataFrame([("m", 1, 5.0), ("m", 2, 9.0), (None, 2, 99.0), ("c", 2, 1.0)], "c string, y int, v double")
    assert rows(series.class_growth(df, "c", F.col("y"), F.col("v"), 1, 2)) == [("c", None, 1.0, None), ("m", 5.0, 9.0, 4.0)]
    m = spark.createDataFrame([("k", date(2019, 3, 1), 1.0), ("k", date(2019, 4, 1), 2.0), ("k", date(2021, 4, 1), 5.0)], "k string, d date, v double")
    assert rows(series.latest_vs_base(m, ["k"], "d", "v", {"y2019": 2019})) == [("k", 5.0, 2.0)]


# Top-k, stacking, reshape ----------------------------------------------------------------------


def test_topk_with_ties(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 3), ("a", "z", 1), ("b", "w", None)], "g string, n string, v int")
    assert rows(topk.top_n(df, "v", 2, ["n"]), "n") == [("x",), ("y",)]
    assert rows(topk.top_n_per_group(df, ["g"], "v", 1, ["n"]), "g", "n", "rank") == [("a", "x", 1), ("b", "w", 1)]


def test_order_by_levels_puts_unknown_last(spark):
    df = spark.createDataFrame([("q",), ("b",), ("a",)], "c string")
    assert [r.c for r in topk.order_by_levels(df, "c", ["b", "a"]).collect()] == ["b", "a", "q"]


def test_slice_counts_rows_that_are_left(spark):
    df = spark.createDataFrame([("f", p, str(p)) for p in (1, 2, 5, 6, 9)], "file string, pos int, v string")
    assert rows(topk.slice_rows(df, 2, 3), "v") == [("2",), ("5",)]
    assert rows(topk.slice_rows(df, 4, None), "v") == [("6",), ("9",)]


def test_stack_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2,)], "a int")
    assert rows(setops.stack(a, b)) == [(1, "x"), (2, None)]


def test_cut_over_never_takes_a_year_twice(spark):
    early = spark.createDataFrame([(y, "e") for y in (2015, 2016, 2017)], "y int, d string")
    late = spark.createDataFrame([(y, "l") for y in (2017, 2018)], "y int, d string")
    assert rows(setops.cut_over(early, late, F.col("y") < 2017, F.col("y") <= 2018)) == [
        (2015, "e"), (2016, "e"), (2017, "l"), (2018, "l")
    ]


@FEW
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=10))
def test_unpivot_then_pivot_is_identity(spark, data):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, `m.a` int, `m b` int")
    long = reshape.unpivot_except(df, ["i"], "n", "v")
    assert long.count() == 2 * len(data)
    back = reshape.pivot_periods(long, ["i"], F.col("n"), F.col("v"), {"a": "m.a", "b": "m b"})
    assert rows(back) == [(i, *r) for i, r in enumerate(data)]
    both = reshape.unpivot_like(df, r"\.", "n", "v", cast="string")
    assert both.columns == ["i", "m b", "n", "v"]


def test_split_into(spark):
    df = spark.createDataFrame([("1996-Q1-x-y",), ("1996",), (None,)], "c string")
    assert rows(reshape.split_into(df, "c", ["a", "b", "d"], "-")) == [(None, None, None), ("1996", None, None), ("1996", "Q1", "x")]
