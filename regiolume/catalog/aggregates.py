"""Aggregates, totals and shares on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiolume.catalog.registry import Tables, query
from regiolume.functions import dates, numbers
from regiolume.functions.recode import null_if
from regiolume.operators import aggregate, project, quantile, totals

def order_year():
    return F.year("o_orderdate").alias("yr")


def customer_sales(t: Tables, *keys):
    """Order value per customer, year and further keys.

    Summed before any join, so a customer with a large part of all orders reaches it as a few rows.
    """
    return t.orders.groupBy("o_custkey", order_year(), *keys).agg(
        F.sum(numbers.money("o_totalprice")).alias("estimate"), F.count("*").alias("n")
    )


def with_place(t: Tables, sales):
    """Customer, nation and region of each row."""
    areas = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    homes = t.customer.join(areas, F.col("c_nationkey") == F.col("n_nationkey"))
    return sales.join(homes, F.col("o_custkey") == F.col("c_custkey"))


def nation_sales(t: Tables, *keys: str):
    """Order value by region, nation and year: the stand-in for a published area table."""
    rows = with_place(t, customer_sales(t, *keys))
    return rows.groupBy("r_name", "n_name", "yr", *keys).agg(
        F.sum("estimate").alias("estimate"), F.sum("n").alias("n")
    )


NATION_SALES_SQL = """
  select r_name, n_name, year(o_orderdate)::int as yr, sum(o_totalprice::decimal(18,2)) as estimate, count(*) as n
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
       join region on n_regionkey = r_regionkey
  group by 1, 2, 3"""


def as_double(df, *names: str):
    return project.across(df, names, lambda c: c.cast("double"))


@query(
    "agg_sum",
    """select l_returnflag, l_linestatus, year(l_shipdate)::int as yr, nullif(l_linenumber, 7) as line,
              sum(l_quantity) as quantity, sum(l_extendedprice::decimal(18,2))::double as price
       from lineitem group by all""",
)
def agg_sum(t: Tables):
    """Four keys, one of them with missing values, which form a group of their own."""
    return t.lineitem.groupBy(
        "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("yr"), null_if("l_linenumber", 7).alias("line")
    ).agg(F.sum("l_quantity").alias("quantity"), numbers.money_sum("l_extendedprice").alias("price"))


@query(
    "agg_sum_strict",
    """select l_suppkey, l_returnflag,
              case when count(nullif(l_tax, 0)) = count(*)
                   then sum(nullif(l_tax, 0)::decimal(18,2))::double end as tax,
              sum(nullif(l_tax, 0)::decimal(18,2))::double as tax_filled
       from lineitem group by 1, 2""",
)
def agg_sum_strict(t: Tables):
    rows = t.lineitem.select(
        "l_suppkey", "l_returnflag", numbers.money(null_if("l_tax", 0.0)).alias("tax")
    )
    out = rows.groupBy("l_suppkey", "l_returnflag").agg(
        aggregate.strict_sum("tax").alias("tax_strict"), F.sum("tax").alias("tax_filled")
    )
    return as_double(out.withColumnRenamed("tax_strict", "tax"), "tax", "tax_filled")


@query(
    "agg_sum_all",
    """select l_returnflag, l_linestatus, sum(l_quantity) as l_quantity,
              sum(l_extendedprice::decimal(18,2))::double as l_extendedprice,
              case when count(nullif(l_discount, 0.1)) = count(*)
                   then sum(nullif(l_discount, 0.1)::decimal(18,2))::double end as l_discount
       from lineitem group by 1, 2""",
)
def agg_sum_all(t: Tables):
    rows = t.lineitem.select(
        "l_returnflag", "l_linestatus", "l_quantity", numbers.money("l_extendedprice").alias("l_extendedprice"),
        numbers.money(null_if("l_discount", 0.1)).alias("l_discount"),
    )
    out = aggregate.sum_rest(rows, ["l_returnflag", "l_linestatus"])
    return as_double(out, "l_extendedprice", "l_discount")


@query(
    "agg_sum_when",
    """select o_orderpriority, sum(case when o_orderstatus = 'F' then o_totalprice::decimal(18,2) end)::double as finished,
              sum(case when o_totalprice > 400000 then o_totalprice::decimal(18,2) end)::double as large from orders group by 1""",
)
def agg_sum_when(t: Tables):
    """Sums under a condition, missing where no row meets it."""
    out = t.orders.groupBy("o_orderpriority").agg(
        aggregate.sum_when(F.col("o_orderstatus") == "F", numbers.money("o_totalprice")).alias("finished"),
        aggregate.sum_when(F.col("o_totalprice") > 400_000, numbers.money("o_totalprice")).alias("large"),
    )
    return as_double(out, "finished", "large")


@query(
    "agg_count_nonnull",
    """select o_orderpriority, nullif(o_orderstatus, 'P') as status, count(case when o_totalprice > 200000 then 1 end) as n
       from orders where o_orderstatus <> 'P' group by 1, 2""",
)
def agg_count_nonnull(t: Tables):
    """Filled values are counted; rows with a missing key are left out."""
    rows = t.orders.select(
        "o_orderpriority", null_if("o_orderstatus", "P").alias("status"),
        F.when(F.col("o_totalprice") > 200_000, F.col("o_totalprice")).alias("price"),
    )
    return aggregate.count_filled(rows, ["o_orderpriority", "status"], "price", "n")


@query(
    "agg_max_multi",
    """select l_partkey, max(l_quantity) as l_quantity, max(l_extendedprice) as l_extendedprice,
              max(l_shipdate)::date as l_shipdate
       from lineitem group by 1""",
)
def agg_max_multi(t: Tables):
    out = aggregate.max_each(t.lineitem, ["l_partkey"], ["l_quantity", "l_extendedprice", "l_shipdate"])
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@query(
    "agg_rounded",
    """select year(o_orderdate)::int as yr, o_orderpriority,
              round_even(sum(o_totalprice::decimal(18,2))::double, -3) as sum_rounded,
              sum(round_even(o_totalprice, -2)) as rounded_sum
       from orders group by 1, 2""",
)
def agg_rounded(t: Tables):
    """Rounding the sum and summing rounded values are different things."""
    return t.orders.groupBy(order_year(), "o_orderpriority").agg(
        numbers.half_even(numbers.money_sum("o_totalprice"), -3).alias("sum_rounded"),
        F.sum(numbers.half_even("o_totalprice", -2)).alias("rounded_sum"),
    )


@query(
    "global_scalars",
    """with s as (select max(o_totalprice) as a, min(o_totalprice) filter (o_orderstatus = 'F') as b,
                         sum(o_totalprice::decimal(18,2)) filter (year(o_orderdate) = 2000)::double as c,
                         count(*) filter (o_orderpriority = '1-URGENT')::double as d,
                         max(year(o_orderdate))::double as e from orders)
       select 'highest' as metric, a as value from s union all select 'lowest finished', b from s
       union all select 'total 2000', c from s union all select 'urgent', d from s union all select 'last year', e from s""",
)
def global_scalars(t: Tables):
    price, status, year = F.col("o_totalprice"), F.col("o_orderstatus"), F.year("o_orderdate")
    return aggregate.scalars(t.orders, {
        "highest": F.max(price),
        "lowest finished": F.min(F.when(status == "F", price)),
        "total 2000": F.sum(F.when(year == 2000, numbers.money(price))),
        "urgent": F.count_if(F.col("o_orderpriority") == "1-URGENT"),
        "last year": F.max(year),
    })


@query(
    "weekly_median",
    """select event_type, ((dayofyear(ts) - 1) // 7 + 1)::int as week, median(value) as median
       from events group by 1, 2""",
)
def weekly_median(t: Tables):
    """Exact median per type and seven-day block of the year."""
    rows = t.events.select("event_type", dates.week_block("ts").alias("week"), "value")
    return quantile.exact_median(rows, ["event_type", "week"], "value")


@query(
    "median_price",
    """select year(o_orderdate)::int as yr, o_orderpriority, median(o_totalprice) as median_price
       from orders group by 1, 2""",
)
def median_price(t: Tables):
    rows = t.orders.select(order_year(), "o_orderpriority", "o_totalprice")
    return quantile.exact_quantile(rows, ["yr", "o_orderpriority"], "o_totalprice", 0.5, "median_price")


def _quantiles_sql(value: str, keys: str, source: str, kind: str) -> str:
    """Quartiles and median of exact numbers: neighbours by rank, mixed as decimals."""

    def at(name: str, a: int) -> str:
        lo, hi = f"max(v) filter (r = ((n - 1) * {a}) // 100)", f"max(v) filter (r = ((n - 1) * {a} + 99) // 100)"
        return f"({lo} + ({hi} - {lo}) * (any_value((n - 1) * {a} % 100)::decimal(4,0) * 0.01))::{kind}::varchar as {name}"

    return f"""
        with x as (select {keys}, {value} as v, row_number() over (partition by {keys} order by {value}) - 1 as r,
                          count(*) over (partition by {keys}) as n from {source} where {value} is not null)
        select {keys}, {at('q1', 25)}, {at('median', 50)}, {at('q3', 75)} from x group by {keys}"""


@query(
    "quartiles_decimal",
    _quantiles_sql("o_totalprice::decimal(18,2)", "o_orderpriority", "orders", "decimal(24,4)"),
)
def quartiles_decimal(t: Tables):
    """Quartiles and median of a decimal column from one scan, as decimals."""
    rows = t.orders.select("o_orderpriority", numbers.money("o_totalprice").alias("price"))
    found = quantile.exact_quantiles(rows, ["o_orderpriority"], "price", {"q1": 0.25, "median": 0.5, "q3": 0.75}, rows=700)
    return project.across(found, ["q1", "median", "q3"], lambda c: c.cast("string"))


@query(
    "quartiles_whole",
    _quantiles_sql("(l_orderkey + 9007199254740993)::decimal(20,0)", "l_returnflag", "lineitem", "decimal(22,2)"),
)
def quartiles_whole(t: Tables):
    """Whole numbers that doubles would round: beyond 2**53 every unit counts."""
    rows = t.lineitem.select("l_returnflag", (F.col("l_orderkey").cast("long") + 9_007_199_254_740_993).alias("key"))
    found = quantile.exact_quantiles(rows, ["l_returnflag"], "key", {"q1": 0.25, "median": 0.5, "q3": 0.75}, rows=700)
    return project.across(found, ["q1", "median", "q3"], lambda c: c.cast("string"))


@query(
    "unique_transactions",
    """select any_value(event_id) as event_id, ts::date as day, user_id, event_type from events
       group by ts::date, user_id, event_type having count(*) = 1""",
)
def unique_transactions(t: Tables):
    """Rows whose (day, user, type) occurs once; the others are bulk transactions."""
    rows = t.events.select("event_id", F.col("ts").cast("date").alias("day"), "user_id", "event_type")
    return aggregate.unique_rows(rows, ["day", "user_id", "event_type"])


@query(
    "union_totals",
    """with s as (select c_mktsegment, year(o_orderdate)::int as yr, sum(o_totalprice::decimal(18,2)) as amount
                  from orders join customer on o_custkey = c_custkey group by 1, 2)
       select yr, c_mktsegment, amount::double as amount from s
       union all select yr, 'Total', sum(amount)::double from s group by 1""",
)
def union_totals(t: Tables):
    sales = customer_sales(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = sales.select("yr", "c_mktsegment", F.col("estimate").alias("amount"))
    return as_double(totals.add_total(rows, ["yr"], "c_mktsegment", ["amount"]), "amount")


@query(
    "region_rollup",
    f"""with s as ({NATION_SALES_SQL})
       select n_name, yr, estimate::double as estimate from s
       union all
       select 'Region', yr, sum(estimate)::double from s where n_name <> 'NATION_0' group by 2""",
)
def region_rollup(t: Tables):
    """Area rows plus the region; the area named as the state stays out of the region."""
    rows = nation_sales(t).select("n_name", "yr", "estimate")
    return as_double(totals.add_region(rows, "n_name", ["yr"], ["estimate"], outside=["NATION_0"]), "estimate")


LEVEL_LABELS = {1: "Region", 2: "Unincorporated Region", 3: "Incorporated Region"}


@query(
    "region_rollup_levels",
    """with s as (select case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as level, n_name,
                         year(o_orderdate)::int as yr, sum(o_totalprice::decimal(18,2)) as estimate
                  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
                  group by 1, 2, 3)
       select level, n_name, yr, estimate::double as estimate from s
       union all
       select level, case level when 1 then 'Region' when 2 then 'Unincorporated Region' else 'Incorporated Region' end,
              yr, sum(estimate)::double from s group by 1, 3""",
)
def region_rollup_levels(t: Tables):
    level = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    rows = with_place(t, customer_sales(t, level.alias("level"))).select("level", "n_name", "yr", "estimate")
    return as_double(
        totals.add_region_levels(rows, "level", "n_name", ["yr"], ["estimate"], LEVEL_LABELS), "estimate"
    )


@query(
    "bucket_merge",
    """with s as (select 'size ' || (p_size // 10) as bucket, p_type, count(*) as n from part group by 1, 2)
       select bucket, p_type, n from s
       union all select 'size 0-1', p_type, sum(n)::bigint from s where bucket in ('size 0', 'size 1') group by 2""",
)
def bucket_merge(t: Tables):
    bucket = F.concat(F.lit("size "), F.floor(F.col("p_size") / 10))
    rows = t.part.groupBy(bucket.alias("bucket"), "p_type").agg(F.count("*").alias("n"))
    return totals.merge_buckets(rows, "bucket", ["p_type"], ["n"], {"size 0-1": ["size 0", "size 1"]})


@query(
    "merge_parts",
    """select n_name as place, year(o_orderdate)::int as yr, sum(o_totalprice::decimal(18,2))::double as estimate
       from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2""",
)
def merge_parts(t: Tables):
    """Places that lie in several segments come as parts and leave as one row."""
    name = F.when(F.col("c_mktsegment") == "BUILDING", F.col("n_name")).otherwise(
        F.concat(F.col("n_name"), F.lit(" (part)"))
    )
    rows = with_place(t, customer_sales(t)).select(name.alias("place"), "yr", "estimate")
    return as_double(totals.merge_parts(rows, "place", ["yr"], ["estimate"]), "estimate")


@query(
    "residual_category",
    """select yr, o_orderpriority, amount::double as amount from (
         select year(o_orderdate)::int as yr, o_orderpriority, sum(o_totalprice::decimal(18,2)) as amount
         from orders where o_orderpriority <> '5-LOW' group by 1, 2
         union all
         select year(o_orderdate)::int, 'All', sum(o_totalprice::decimal(18,2)) from orders group by 1
         union all
         select year(o_orderdate)::int, 'Other', sum(o_totalprice::decimal(18,2)) from orders
         where o_orderpriority = '5-LOW' group by 1)""",
)
def residual_category(t: Tables):
    """The total and four of five categories are published; the fifth is what is left."""
    published = totals.add_total(
        t.orders.select(order_year(), "o_orderpriority", numbers.money("o_totalprice").alias("amount")),
        ["yr"], "o_orderpriority", ["amount"], label="All",
    ).filter(F.col("o_orderpriority") != "5-LOW")
    named = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
    rest = totals.residual_rows(published, "o_orderpriority", ["yr"], "amount", "All", named, "Other")
    return as_double(published.unionByName(rest), "amount")


@query(
    "share_of_group",
    f"""with s as ({NATION_SALES_SQL})
       select r_name, yr, n_name, estimate::double as estimate, sum(estimate) over (partition by r_name, yr)::double as total,
              estimate::double / nullif(sum(estimate) over (partition by r_name, yr)::double, 0) as share
       from s""",
)
def share_of_group(t: Tables):
    sales = nation_sales(t)
    out = aggregate.share_within(sales, ["r_name", "yr"], ["n_name"], F.col("estimate"))
    return as_double(out, "estimate", "total").withColumn("share", numbers.ratio("estimate", "total"))


@query(
    "ratio_of_sums",
    """select c_mktsegment,
              sum(case when year(o_orderdate) = 2000 then o_totalprice::decimal(18,2) end)::double
              / nullif(sum(case when year(o_orderdate) = 1996 then o_totalprice::decimal(18,2) end)::double, 0) as ratio
       from orders join customer on o_custkey = c_custkey group by 1""",
)
def ratio_of_sums(t: Tables):
    rows = customer_sales(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    new, base = (F.when(F.col("yr") == y, F.col("estimate")) for y in (2000, 1996))
    return rows.groupBy("c_mktsegment").agg(aggregate.ratio_of_sums(new, base).alias("ratio"))
