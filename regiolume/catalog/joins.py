"""Joins on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiolume.catalog.registry import Tables, query
from regiolume.functions.numbers import money_sum, ratio
from regiolume.functions.recode import null_if
from regiolume.operators import joins

# Order priority -> class.
PRIORITY_CLASS = {"1-URGENT": "fast", "2-HIGH": "fast", "3-MEDIUM": "normal", "4-NOT SPECIFIED": "normal"}


@query(
    "left_join_single",
    """select c.c_custkey, c.c_nationkey, n.n_name, n.n_regionkey
       from customer c left join nation n on c.c_nationkey = n.n_nationkey and n.n_regionkey < 3""",
)
def left_join_single(t: Tables):
    nations = t.nation.filter(F.col("n_regionkey") < 3).withColumnRenamed("n_nationkey", "c_nationkey")
    return joins.left_join(t.customer.select("c_custkey", "c_nationkey"), nations, "c_nationkey")


@query(
    "left_join_composite",
    """with o as (select o_custkey as k, year(o_orderdate)::int as yr, count(*) as n from orders group by all),
            s as (select l_suppkey as k, year(l_shipdate)::int as yr, count(*) as shipped from lineitem group by all)
       select o.k, o.yr, o.n, s.shipped from o left join s on o.k = s.k and o.yr = s.yr""",
)
def left_join_composite(t: Tables):
    ordered = t.orders.groupBy(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("yr")).agg(
        F.count("*").alias("n")
    )
    shipped = t.lineitem.groupBy(F.col("l_suppkey").alias("k"), F.year("l_shipdate").alias("yr")).agg(
        F.count("*").alias("shipped")
    )
    return joins.left_join(ordered, shipped, ["k", "yr"])


@query(
    "left_join_renamed",
    """select o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment
       from orders o left join customer c on o.o_custkey = c.c_custkey""",
)
def left_join_renamed(t: Tables):
    return joins.left_join(
        t.orders.select("o_orderkey", "o_custkey"),
        t.customer.select("c_custkey", "c_name", "c_mktsegment"),
        {"o_custkey": "c_custkey"},
        null_keys_match=False,  # customer numbers are never missing
    )


@query(
    "left_join_default",
    """select d.doc_id, d.source, coalesce(l.quality, -1) as quality, coalesce(l.toxic, -1) as toxic
       from documents d left join labels l using (doc_id)""",
)
def left_join_default(t: Tables):
    return joins.left_join(
        t.documents.select("doc_id", "source"), t.labels, "doc_id", defaults={"quality": -1, "toxic": -1}
    )


@query(
    "left_join_nullsafe",
    """with a as (select o_orderkey, nullif(o_orderstatus, 'P') as status from orders),
            b as (select nullif(o_orderstatus, 'P') as status, count(*) as n from orders group by 1)
       select a.o_orderkey, a.status, b.n from a left join b on a.status is not distinct from b.status""",
)
def left_join_nullsafe(t: Tables):
    """A missing key finds the group of the missing key."""
    rows = t.orders.select("o_orderkey", null_if("o_orderstatus", "P").alias("status"))
    sizes = rows.groupBy("status").agg(F.count("*").alias("n"))
    return joins.left_join(rows, joins.sized(sizes), "status")


@query(
    "join_aggregate_back",
    """select l_orderkey, l_linenumber, l_quantity, total, lines, l_quantity / nullif(total, 0) as share
       from lineitem join (select l_returnflag as f, l_linestatus as s, sum(l_quantity) as total, count(*) as lines
                           from lineitem group by 1, 2) on l_returnflag = f and l_linestatus = s""",
)
def join_aggregate_back(t: Tables):
    """Every row next to the total and the count of its group; a few groups hold all rows."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    both = joins.with_totals(
        rows, ["l_returnflag", "l_linestatus"], {"total": F.sum("l_quantity"), "lines": F.count("*")}
    )
    return both.drop("l_returnflag", "l_linestatus").withColumn("share", ratio("l_quantity", "total"))


@query(
    "join_suffixes",
    """with a as (select o_custkey, count(*) as n, max(o_totalprice) as top from orders
                  where o_orderstatus = 'F' group by 1),
            b as (select o_custkey, count(*) as n, max(o_totalprice) as top from orders
                  where o_orderstatus = 'O' group by 1)
       select a.o_custkey, a.n as n_x, a.top as top_x, b.n as n_y, b.top as top_y
       from a left join b using (o_custkey)""",
)
def join_suffixes(t: Tables):
    def by_status(status: str):
        rows = t.orders.filter(F.col("o_orderstatus") == status)
        return rows.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))

    return joins.left_join_suffixed(by_status("F"), by_status("O"), ["o_custkey"])


@query(
    "join_unique_guard",
    "select l_orderkey, l_partkey, count(*) as rows from lineitem group by 1, 2 having count(*) > 1",
)
def join_unique_guard(t: Tables):
    """Keys that would fan out if the table stood on the right side of a join."""
    return joins.duplicate_keys(t.lineitem, ["l_orderkey", "l_partkey"])


@query(
    "lookup_recode",
    """select coalesce(case o_orderpriority when '1-URGENT' then 'fast' when '2-HIGH' then 'fast'
                            when '3-MEDIUM' then 'normal' when '4-NOT SPECIFIED' then 'normal' end, 'other') as class,
              year(o_orderdate)::int as yr, sum(o_totalprice::decimal(18,2))::double as amount
       from orders group by 1, 2""",
)
def lookup_recode(t: Tables):
    rows = joins.lookup(t.orders, PRIORITY_CLASS, "o_orderpriority", "class", default="other")
    return rows.groupBy("class", F.year("o_orderdate").alias("yr")).agg(money_sum("o_totalprice").alias("amount"))


FAN_OUT_SQL = """
  l as (select nullif(o_custkey % 97, 5) as k, count(*) as l from orders group by 1),
  r as (select nullif(l_suppkey % 89, 5) as k, count(*) as r from lineitem group by 1),
  c as (select l.k, coalesce(l, 0) as l, coalesce(r, 0) as r, coalesce(l, 0) * coalesce(r, 0) as j
        from l full join r on l.k is not distinct from r.k)"""


def fan_out_sides(t: Tables):
    orders = t.orders.select(null_if(F.col("o_custkey") % 97, 5).alias("k"), "o_orderkey")
    return orders, t.lineitem.select(null_if(F.col("l_suppkey") % 89, 5).alias("s"), "l_linenumber")


@query(
    "join_fan_out",
    f"""with {FAN_OUT_SQL}
       select (select count(*) from orders)::bigint as left_rows, (select count(*) from lineitem)::bigint as right_rows,
              (select count(*) from (select nullif(o_custkey % 97, 5) as k from orders) a
                 join (select nullif(l_suppkey % 89, 5) as k from lineitem) b on a.k is not distinct from b.k)::bigint as inner_rows,
              sum(case when j = 0 then l else j end)::bigint as left_join_rows, sum(case when j = 0 then l else 0 end)::bigint as unmatched_left,
              count(*) filter (j > l) as keys, max(j)::bigint as largest from c""",
)
def join_fan_out(t: Tables):
    """What a join will give, told from the counts of its keys; the SQL counts the joined rows themselves."""
    out = joins.predict_join(*fan_out_sides(t), {"k": "s"})
    return out.select(*[F.col(c).cast("bigint").alias(c) for c in out.columns])


@query(
    "join_worst_keys",
    f"with {FAN_OUT_SQL} select k, l as left_rows, r as right_rows, j::bigint as joined_rows from c where j > 0 order by j desc, k nulls first limit 7",
)
def join_worst_keys(t: Tables):
    """The keys that make most rows."""
    out = joins.worst_keys(*fan_out_sides(t), {"k": "s"}, 7)
    return out.withColumn("joined_rows", F.col("joined_rows").cast("bigint"))
