"""Time-series operators and top-k on the benchmark tables."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from regiolume.catalog.aggregates import NATION_SALES_SQL, as_double, nation_sales
from regiolume.catalog.registry import Tables, query
from regiolume.functions.numbers import money, ratio
from regiolume.operators import aggregate, filters, joins, nearest, ranges, series, topk
from regiolume.operators.series import Event

def order_month():
    return F.trunc(F.col("o_orderdate").cast("date"), "month")


def monthly(t: Tables, *keys: str):
    """Order value per month, exact."""
    return t.orders.groupBy(*keys, order_month().alias("month")).agg(F.sum(money("o_totalprice")).alias("estimate"))


MONTHLY_SQL = """
  select date_trunc('month', o_orderdate)::date as month, sum(o_totalprice::decimal(18,2)) as estimate
  from orders group by 1"""

MONTHLY_PRIORITY_SQL = """
  select o_orderpriority, date_trunc('month', o_orderdate)::date as month, sum(o_totalprice::decimal(18,2)) as estimate
  from orders group by 1, 2"""


@query(
    "delta_prev",
    f"""with s as ({NATION_SALES_SQL})
       select n_name, yr, estimate::double as estimate,
              (estimate - lag(estimate) over (partition by n_name order by yr))::double as delta from s""",
)
def delta_prev(t: Tables):
    rows = nation_sales(t).select("n_name", "yr", "estimate")
    return as_double(series.delta_prev(rows, "estimate", ["n_name"], "yr"), "estimate", "delta")


@query(
    "delta_same_month",
    f"""select o_orderpriority, month, estimate::double as estimate,
              (estimate - lag(estimate) over (partition by o_orderpriority order by month))::double as delta
       from ({MONTHLY_PRIORITY_SQL}) where month(month) = 7""",
)
def delta_same_month(t: Tables):
    rows = monthly(t, "o_orderpriority")
    return as_double(
        series.delta_same_month(rows, "estimate", ["o_orderpriority"], "month", 7), "estimate", "delta"
    )


@query(
    "delta_target_year",
    f"""with s as ({NATION_SALES_SQL})
       select n_name, yr, case when yr = 2000 then
              (estimate - lag(estimate) over (partition by n_name order by yr))::double end as delta from s""",
)
def delta_target_year(t: Tables):
    rows = nation_sales(t).select("n_name", "yr", "estimate")
    out = series.delta_target(rows, "estimate", ["n_name"], "yr", 2000)
    return as_double(out.drop("estimate"), "delta")


@query(
    "period_compare",
    f"""with s as ({NATION_SALES_SQL}),
            w as (select n_name, sum(estimate) filter (yr = 1996)::double as y1996, sum(estimate) filter (yr = 2000)::double as y2000
                  from s group by 1)
       select n_name, y1996, y2000, (select 1) * (y2000::decimal(18,2) - y1996::decimal(18,2))::double as delta,
              (y2000 - y1996) * 100 / nullif(y1996, 0) as pct, y2000 / nullif(y1996, 0) as ratio from w""",
)
def period_compare(t: Tables):
    rows = nation_sales(t)
    out = series.compare_periods(
        rows, ["n_name"], F.col("yr"), F.col("estimate"), {"y1996": 1996, "y2000": 2000}
    )
    out = as_double(out, "y1996", "y2000", "delta")
    return out.withColumns({
        "pct": ratio((F.col("y2000") - F.col("y1996")) * 100, "y1996"), "ratio": ratio("y2000", "y1996")
    })


@query(
    "latest_vs_base",
    f"""with s as ({MONTHLY_PRIORITY_SQL}), m as (select max(month) as last from s)
       select o_orderpriority, sum(estimate) filter (month = last)::double as latest,
              sum(estimate) filter (month(month) = month(last) and year(month) = 1996)::double as y1996,
              sum(estimate) filter (month(month) = month(last) and year(month) = 2000)::double as y2000
       from s, m group by 1""",
)
def latest_vs_base(t: Tables):
    out = series.latest_vs_base(
        monthly(t, "o_orderpriority"), ["o_orderpriority"], "month", "estimate", {"y1996": 1996, "y2000": 2000}
    )
    return as_double(out, "latest", "y1996", "y2000")


@query(
    "class_growth",
    f"""with s as ({NATION_SALES_SQL}),
            c as (select case when n_name like '%\\_1%' escape '\\' then 'One' when r_name <> 'ASIA' then r_name end as class, yr, estimate from s)
       select class, sum(estimate) filter (yr = 1996)::double as first, sum(estimate) filter (yr = 2000)::double as last,
              (sum(estimate) filter (yr = 2000) - sum(estimate) filter (yr = 1996))::double as delta
       from c where class is not null and yr in (1996, 2000) group by 1""",
)
def class_growth(t: Tables):
    """A text test decides the class first; otherwise the class the place has, which may be missing."""
    cls = F.when(F.col("n_name").rlike("_1"), "One").otherwise(F.nullif(F.col("r_name"), F.lit("ASIA")))
    out = series.class_growth(nation_sales(t), cls, F.col("yr"), F.col("estimate"), 1996, 2000)
    return as_double(out, "first", "last", "delta")


DELTAS_SQL = f"""
  select r_name, n_name, (sum(estimate) filter (yr = 2000) - sum(estimate) filter (yr = 1996))::double as delta
  from ({NATION_SALES_SQL}) group by 1, 2"""


def nation_deltas(t: Tables):
    out = series.compare_periods(
        nation_sales(t), ["r_name", "n_name"], F.col("yr"), F.col("estimate"), {"a": 1996, "b": 2000}
    )
    return as_double(out.select("r_name", "n_name", "delta"), "delta")


@query("topn_region", f"select r_name, n_name, delta from ({DELTAS_SQL}) order by delta desc, n_name limit 10")
def topn_region(t: Tables):
    return topk.top_n(nation_deltas(t), "delta", 10, ["n_name"])


@query(
    "topn_county_counts",
    f"""select r_name, count(*) as n from (select * from ({DELTAS_SQL}) order by delta desc, n_name limit 10) group by 1""",
)
def topn_county_counts(t: Tables):
    """How many of the ten fastest lie in each area."""
    return topk.top_n(nation_deltas(t), "delta", 10, ["n_name"]).groupBy("r_name").agg(F.count("*").alias("n"))


@query(
    "topn_per_group",
    """select o_orderpriority, o_orderkey, o_totalprice, rank from (
         select o_orderpriority, o_orderkey, o_totalprice,
                row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey)::int as rank from orders)
       where rank <= 10""",
)
def topn_per_group(t: Tables):
    rows = t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice")
    return topk.top_n_per_group(rows, ["o_orderpriority"], "o_totalprice", 10, ["o_orderkey"])


# Three chosen peaks in the monthly series.
EVENTS = [
    Event("first", "1996-05-01", end="1998-12-01"),
    Event("second", "1998-03-01", with_peak=True),
    Event("third", "2000-01-01", below_peak=False, end="2000-12-01"),
]

EVENTS_SQL = f"""
  with s as ({MONTHLY_SQL}),
  e(event, peak, until, with_peak, below_peak) as (values
    ('first', date '1996-05-01', date '1998-12-01', false, true),
    ('second', date '1998-03-01', null, true, true),
    ('third', date '2000-01-01', date '2000-12-01', false, false)),
  l as (select e.*, round_even(estimate::double, -1) as level from e join s on month = peak)"""


@query(
    "event_index",
    EVENTS_SQL + """
  select event, month, estimate::double as estimate, row_number() over (partition by event order by month)::int as index
  from s join l on month >= peak and (with_peak or month > peak) and (not below_peak or estimate::double <= level)
                   and (until is null or month <= until)""",
)
def event_index(t: Tables):
    return series.event_curves(as_double(monthly(t), "estimate"), [], "month", "estimate", EVENTS)


@query(
    "return_to_peak",
    EVENTS_SQL + """,
  d as (select event, peak, level, min(month) filter (estimate::double < level) as dip
        from l join s on month >= peak group by 1, 2, 3),
  r as (select event, peak, level, min(month) filter (month > dip and estimate::double >= level) as returned
        from d join s on month >= peak group by 1, 2, 3)
  select event, peak, level, returned, round_even(datediff('day', peak, returned) * 86400.0 / 31536000, 1)::double as years from r""",
)
def return_to_peak(t: Tables):
    return series.return_to_peak(as_double(monthly(t), "estimate"), [], "month", "estimate", EVENTS)


@query(
    "nearest_period",
    f"""with s as ({MONTHLY_SQL}), p as (select month, round_even(estimate::double, -5) as estimate from s),
            x as (select estimate as target from p where month = date '2001-07-01'),
            d as (select month, estimate, abs(estimate - target) as diff from p, x where month < date '2001-01-01')
       select * from d where diff = (select min(diff) from d)""",
)
def nearest_period(t: Tables):
    """Months whose value comes closest to the latest full month, ties kept."""
    rows = monthly(t).select("month", F.bround(F.col("estimate").cast("double"), -5).alias("estimate"))
    target = rows.filter(F.col("month") == F.lit("2001-07-01").cast("date")).select("estimate").scalar()
    past = rows.filter(F.col("month") < F.lit("2001-01-01").cast("date"))
    return series.nearest_period(past, "estimate", target)


@query(
    "nearest_other",
    f"""with s as (select o_orderpriority, month, round_even(estimate::double, -4) as estimate from ({MONTHLY_PRIORITY_SQL})),
            p as (select a.o_orderpriority, a.month, a.estimate, b.month as near_month, b.estimate as near_estimate,
                         abs(a.estimate - b.estimate) as diff
                  from s a join s b on a.o_orderpriority = b.o_orderpriority and a.month <> b.month)
       select * from p qualify diff = min(diff) over (partition by o_orderpriority, month)""",
)
def nearest_other(t: Tables):
    """Every month's most similar other months of the same priority, ties kept, in one plan."""
    rows = monthly(t, "o_orderpriority").withColumn("estimate", F.bround(F.col("estimate").cast("double"), -4))
    return nearest.nearest_other(joins.sized(rows), "estimate", "month", ["o_orderpriority"])


@query(
    "nearest_rows",
    """with v as (select o_orderkey, floor(o_totalprice / 10) * 10 as price from orders),
            t as (select c_custkey, floor(abs(c_acctbal) * 45 / 10) * 10 as price from customer),
            d as (select c_custkey, t.price, (select max(v.price) from v where v.price <= t.price) as low,
                         (select min(v.price) from v where v.price >= t.price) as high from t),
            n as (select c_custkey, price, unnest(list_distinct(case when high is null or price - low < high - price then [low]
                         when low is null or high - price < price - low then [high] else [low, high] end)) as near from d)
       select c_custkey, n.price, o_orderkey as near_o_orderkey, v.price as near_price, abs(n.price - v.price) as diff
       from n join v on n.near = v.price""",
)
def nearest_rows(t: Tables):
    """A table of targets against a long table of values without keys: one merged order, cut into blocks."""
    values = t.orders.select("o_orderkey", (F.floor(F.col("o_totalprice") / 10) * 10).cast("double").alias("price"))
    targets = t.customer.select("c_custkey", (F.floor(F.abs("c_acctbal") * 45 / 10) * 10).cast("double").alias("price"))
    return nearest.nearest_rows(values, targets, "price", rows=2000)


@query(
    "forward_fill",
    """with s as (select o_orderkey, o_custkey,
                         case when row_number() over (partition by o_custkey, year(o_orderdate) order by o_orderkey) = 1
                                   and o_orderkey % 3 <> 0
                              then year(o_orderdate)::varchar end as label from orders)
       select o_orderkey, o_custkey, last_value(label ignore nulls) over (partition by o_custkey order by o_orderkey
              rows between unbounded preceding and current row) as label from s""",
)
def forward_fill(t: Tables):
    """A label stands only on some rows; the rows below belong to it. Long customers are cut into blocks."""
    first = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(F.min("o_orderkey").alias("first_key"))
    rows = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("yr"))
    marks = first.filter(F.col("first_key") % 3 != 0).select(
        F.col("first_key").alias("o_orderkey"), F.col("yr").cast("string").alias("label")
    )
    labelled = joins.left_join(rows, marks, "o_orderkey").select("o_orderkey", "o_custkey", "label")
    return series.forward_fill(
        labelled, "label", "o_orderkey", ["o_custkey"], block=F.floor(F.col("o_orderkey") / 5000)
    )


EVENT_KEY_SQL = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || lpad(event_id::varchar, 12, '0')"


@query(
    "delta_long",
    """select event_id, value, value - lag(value) over (order by ts, event_id) as delta,
              value - lag(value) over (partition by event_type order by ts, event_id) as delta_type from events""",
)
def delta_long(t: Tables):
    """All events are one series, and one for each type, in the order of time: cut into blocks, no series in one task."""
    rows = t.events.select("event_id", "event_type", F.struct("ts", "event_id").alias("at"), "value")
    one = series.delta_prev(rows, "value", [], "at", block_rows=500)
    both = series.delta_prev(one, "value", ["event_type"], "at", "delta_type", block_rows=500)
    return both.select("event_id", "value", "delta", "delta_type")


@query(
    "delta_long_month",
    """with d as (select o_orderpriority, o_orderdate::date as day, sum(o_totalprice::decimal(18,2)) as amount from orders group by 1, 2)
       select o_orderpriority, day,
              (amount - lag(amount) over (partition by o_orderpriority, month(day) order by day))::double as delta,
              case when day = date '2000-07-03'
                   then (amount - lag(amount) over (partition by o_orderpriority order by day))::double end as target from d""",
)
def delta_long_month(t: Tables):
    """Daily sums against the day before in the same month of any year, and one target day's change, in blocks."""
    rows = t.orders.groupBy("o_orderpriority", F.col("o_orderdate").cast("date").alias("day")).agg(
        F.sum(money("o_totalprice")).alias("amount")
    )
    rows = joins.sized(rows)
    month = series.delta_same_month(rows, "amount", ["o_orderpriority"], "day", block_rows=1000)
    day = datetime.date(2000, 7, 3)
    both = series.delta_target(month, "amount", ["o_orderpriority"], "day", day, "target", block_rows=1000)
    return as_double(both.drop("amount"), "delta", "target")


@query(
    "forward_fill_long",
    f"""with s as (select event_id, {EVENT_KEY_SQL} as key, case when event_id % 997 = 5 then event_type end as label from events)
       select event_id, key, last_value(label ignore nulls) over (order by key rows between unbounded preceding and current row) as label
       from s""",
)
def forward_fill_long(t: Tables):
    """One series ordered by text, a label on one row of a thousand: runs without a label reach over several blocks."""
    key = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    label = F.when(F.col("event_id") % 997 == 5, F.col("event_type"))
    rows = t.events.select("event_id", key.alias("key"), label.alias("label"))
    return ranges.fill_forward(rows, "label", "key", rows=500)


INDEX_SQL = """
  with base as (select event_type, max(value) as base from events where ts < timestamp '2024-01-08' group by 1),
  r as (select event_id, event_type, ts::date as day, value / nullif(base, 0) as ratio from events left join base using (event_type))"""


@query("volume_index_clipped", INDEX_SQL + " select * from r where ratio >= 0.1 and ratio <= 2")
def volume_index_clipped(t: Tables):
    """Each value against the first week's highest of its type, outliers dropped."""
    first_week = t.events.filter(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    base = first_week.groupBy("event_type").agg(F.max("value").alias("base"))
    rows = joins.left_join(t.events, joins.sized(base), "event_type").select(
        "event_id", "event_type", F.col("ts").cast("date").alias("day"), ratio("value", "base").alias("ratio")
    )
    return filters.clip_rows(rows, "ratio", 0.1, 2)


@query(
    "ytd_by_mode",
    """with m as (select month(max(o_orderdate)) as last from orders)
       select year(o_orderdate)::int as yr, o_orderpriority, sum(o_totalprice::decimal(18,2))::double as estimate
       from orders, m where month(o_orderdate) <= last and o_orderdate >= timestamp '1996-01-01' group by 1, 2""",
)
def ytd_by_mode(t: Tables):
    """Every year only up to the month the latest year has reached."""
    rows = t.orders.withColumn("day", F.col("o_orderdate").cast("date"))
    kept = filters.year_to_date(rows, "day", first_year=1996)
    out = kept.groupBy(F.year("day").alias("yr"), "o_orderpriority").agg(F.sum(money("o_totalprice")).alias("estimate"))
    return as_double(out, "estimate")
