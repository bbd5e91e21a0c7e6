"""Projections, reshapes and set operations on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiolume.catalog.registry import Tables, query
from regiolume.functions.numbers import money, money_sum, ratio
from regiolume.operators import project, reshape, setops, topk
from regiolume.sources import rename_by_position


@query("proj_select", "select l_orderkey, l_linenumber, l_quantity, l_shipdate::date as l_shipdate from lineitem")
def proj_select(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate").withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date")
    )


@query("proj_drop", "select * exclude (c_name, c_acctbal) from customer")
def proj_drop(t: Tables):
    return project.drop_columns(t.customer, ["c_name", "c_acctbal"])


@query("proj_pattern", "select l_orderkey, l_partkey, l_suppkey from lineitem")
def proj_pattern(t: Tables):
    """Columns by pattern, then without a second pattern."""
    return project.drop_like(project.select_like(t.lineitem, "_.*key|_ship"), "ship")


@query(
    "proj_rename",
    "select o_orderkey as order_id, o_totalprice as amount, o_orderstatus as status from orders",
)
def proj_rename(t: Tables):
    return t.orders.select(F.col("o_orderkey").alias("order_id"), "o_totalprice", "o_orderstatus").withColumnsRenamed(
        {"o_totalprice": "amount", "o_orderstatus": "status"}
    )


@query(
    "rename_positional",
    """select l_orderkey as order_no, l_partkey as part_no, l_suppkey as supplier_no, l_linenumber as line_no,
              l_quantity
       from lineitem""",
)
def rename_positional(t: Tables):
    """Columns 1 to 5 by position; the first four get new names."""
    first = project.select_positions(t.lineitem, 1, 5)
    return rename_by_position(first, ["order_no", "part_no", "supplier_no", "line_no"])


@query(
    "derive_ratio",
    "select l_orderkey, l_linenumber, l_extendedprice / nullif(l_quantity, 0) as unit_price from lineitem",
)
def derive_ratio(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", ratio("l_extendedprice", "l_quantity").alias("unit_price")
    )


@query(
    "across_cast",
    """select l_orderkey, l_linenumber, l_quantity::varchar as l_quantity,
              coalesce(nullif(l_discount, 0), 1) as l_discount, coalesce(nullif(l_tax, 0), 1) as l_tax
       from (select * replace (l_quantity::bigint as l_quantity) from lineitem)""",
)
def across_cast(t: Tables):
    """One function over several columns: a cast, and a missing value replaced by one."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    rows = project.across(rows, ["l_quantity"], lambda c: c.cast("bigint").cast("string"))
    return project.across(rows, ["l_discount", "l_tax"], lambda c: F.coalesce(F.nullif(c, F.lit(0.0)), F.lit(1.0)))


@query("distinct_values", "select distinct p_brand, p_type from part")
def distinct_values(t: Tables):
    return project.distinct_values(t.part, "p_brand", "p_type")


@query(
    "sort_multi",
    """select year(o_orderdate)::int as yr, o_orderpriority, count(*) as n from orders
       group by all order by yr desc, n""",
)
def sort_multi(t: Tables):
    rows = t.orders.groupBy(F.year("o_orderdate").alias("yr"), "o_orderpriority").agg(F.count("*").alias("n"))
    return rows.orderBy(F.col("yr").desc(), "n")


LEVELS = ["3-MEDIUM", "1-URGENT", "5-LOW", "2-HIGH"]


@query(
    "sort_category",
    """select o_orderpriority, count(*) as n,
              nullif(list_position(['3-MEDIUM', '1-URGENT', '5-LOW', '2-HIGH'], o_orderpriority), 0)::int as place
       from orders group by o_orderpriority order by place nulls last""",
)
def sort_category(t: Tables):
    from regiolume.functions.recode import category_rank

    rows = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    ranked = rows.withColumn("place", category_rank("o_orderpriority", LEVELS))
    return topk.order_by_levels(ranked, "o_orderpriority", LEVELS)


@query(
    "union_by_name",
    """select c_custkey as id, c_name as name, c_acctbal as balance, c_mktsegment as segment from customer
       union all
       select s_suppkey, s_name, s_acctbal, null from supplier""",
)
def union_by_name(t: Tables):
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")
    )
    return setops.stack(customers, suppliers)


@query("sort_measure", "select c_custkey, c_acctbal from customer")
def sort_measure(t: Tables):
    """Largest first; the order itself is held by a test."""
    return topk.order_by_measure(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey")


@query(
    "union_cutover",
    """select o_orderkey, o_orderdate::date as day, 'early' as delivery from orders
       where o_orderdate < timestamp '1998-01-01'
       union all
       select o_orderkey, o_orderdate::date, 'late' from orders
       where o_orderdate >= timestamp '1998-01-01'""",
)
def union_cutover(t: Tables):
    """Two deliveries that overlap from 1997 on; the early one ends where the late one takes over."""
    day = F.col("day")
    rows = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    early = rows.filter(day < F.lit("2000-01-01").cast("date")).withColumn("delivery", F.lit("early"))
    late = rows.filter(day >= F.lit("1997-01-01").cast("date")).withColumn("delivery", F.lit("late"))
    cut = F.lit("1998-01-01").cast("date")
    return setops.cut_over(early, late, day < cut, day >= cut)


def _status_by_year(t: Tables):
    """Wide source form: one row per year, one column per order status."""
    price = money("o_totalprice")
    return t.orders.groupBy(F.year("o_orderdate").alias("yr")).agg(*[
        F.sum(F.when(F.col("o_orderstatus") == s, price)).cast("double").alias(f"status_{s}") for s in "FOP"
    ])


@query(
    "unpivot_pattern",
    """select year(o_orderdate)::int as yr, 'status_' || o_orderstatus as status,
              sum(o_totalprice::decimal(18,2))::double as amount
       from orders group by all""",
)
def unpivot_pattern(t: Tables):
    return reshape.unpivot_like(_status_by_year(t), "^status_", "status", "amount")


@query(
    "unpivot_except",
    """unpivot (select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax from lineitem)
       on l_quantity, l_extendedprice, l_discount, l_tax into name name value value""",
)
def unpivot_except(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return reshape.unpivot_except(rows, ["l_orderkey", "l_linenumber"])


@query(
    "metric_series",
    """with m as (
         select date_trunc('month', o_orderdate)::date as month, sum(o_totalprice::decimal(18,2))::double as price,
                count(*)::double as sold, count(distinct o_custkey)::double as buyers
         from orders group by 1)
       select month, 'Sales value' as variable, price as value from m
       union all select month, 'Orders', sold from m
       union all select month, 'Buyers', buyers from m""",
)
def metric_series(t: Tables):
    month = F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")
    wide = t.orders.groupBy(month).agg(
        money_sum("o_totalprice").alias("price"), F.count("*").alias("sold"),
        F.countDistinct("o_custkey").alias("buyers"),
    )
    return reshape.metric_series(wide, "month", {"price": "Sales value", "sold": "Orders", "buyers": "Buyers"})


@query(
    "split_columns",
    """select o_orderkey, year(o_orderdate)::varchar as yr, 'Q' || quarter(o_orderdate) as quarter,
              null::varchar as rest, (month(o_orderdate))::int as month, day(o_orderdate)::int as day,
              year(o_orderdate)::int as full_year
       from orders""",
)
def split_columns(t: Tables):
    """``1996-Q1`` into three pieces (the third is missing) and ``3-14-96`` into numbers."""
    day = F.col("o_orderdate")
    rows = t.orders.select(
        "o_orderkey",
        F.concat(F.year(day), F.lit("-Q"), F.quarter(day)).alias("label"),
        F.concat_ws("-", F.month(day), F.dayofmonth(day), F.date_format(day, "yy")).alias("text"),
    )
    rows = reshape.split_into(rows, "label", ["yr", "quarter", "rest"], "-")
    rows = reshape.split_into(rows, "text", ["m", "d", "y"], "-")
    short = F.col("y").try_cast("int")
    return rows.select(
        "o_orderkey", "yr", "quarter", "rest",
        F.col("m").try_cast("int").alias("month"), F.col("d").try_cast("int").alias("day"),
        (short + F.when(short >= 69, 1900).otherwise(2000)).alias("full_year"),
    )


@query(
    "pivot_periods",
    """select o_orderpriority,
              sum(case when year(o_orderdate) = 1996 then o_totalprice::decimal(18,2) end)::double as y1996,
              sum(case when year(o_orderdate) = 2000 then o_totalprice::decimal(18,2) end)::double as y2000
       from orders group by 1""",
)
def pivot_periods(t: Tables):
    wide = reshape.pivot_periods(
        t.orders, ["o_orderpriority"], F.year("o_orderdate"), money("o_totalprice"), {"y1996": 1996, "y2000": 2000}
    )
    return project.across(wide, ["y1996", "y2000"], lambda c: c.cast("double"))
