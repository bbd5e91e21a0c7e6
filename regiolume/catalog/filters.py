"""Filters on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiolume.catalog.registry import Tables, query
from regiolume.functions.numbers import money_sum, sentinel_number
from regiolume.functions.recode import fill_null, not_in_keep_null, null_if
from regiolume.functions.text import matches_any
from regiolume.operators import filters, joins, project


@query(
    "filter_basic",
    """select o_orderkey, o_totalprice from orders
       where o_totalprice > 250000 and o_orderstatus = 'F' and o_orderpriority <> '5-LOW'""",
)
def filter_basic(t: Tables):
    return t.orders.filter(
        (F.col("o_totalprice") > 250_000) & (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW")
    ).select("o_orderkey", "o_totalprice")


@query("filter_or", "select p_partkey, p_size from part where p_size = 2 or p_size = 4 or p_size = 6 or p_size = 8")
def filter_or(t: Tables):
    size = F.col("p_size")
    return t.part.filter(filters.any_of([size == 2, size == 4, size == 6, size == 8])).select("p_partkey", "p_size")


@query("filter_in", "select p_partkey, p_type from part where p_type in ('ECONOMY', 'PROMO')")
def filter_in(t: Tables):
    return t.part.filter(F.col("p_type").isin("ECONOMY", "PROMO")).select("p_partkey", "p_type")


@query(
    "filter_not_in_keep_null",
    """select o_orderkey, status from (select o_orderkey, nullif(o_orderstatus, 'P') as status from orders)
       where status is null or status not in ('F')""",
)
def filter_not_in_keep_null(t: Tables):
    rows = t.orders.select("o_orderkey", null_if("o_orderstatus", "P").alias("status"))
    return rows.filter(not_in_keep_null("status", ["F"]))


@query(
    "filter_null",
    """select status is null as missing, count(*) as n, sum(o_totalprice::decimal(18,2))::double as amount
       from (select nullif(o_orderstatus, 'P') as status, o_totalprice from orders) group by 1""",
)
def filter_null(t: Tables):
    """Rows with a missing and rows with a filled status, counted apart."""
    rows = t.orders.select(null_if("o_orderstatus", "P").alias("status"), "o_totalprice")
    aggs = [F.count("*").alias("n"), money_sum("o_totalprice").alias("amount")]
    missing = rows.filter(F.col("status").isNull()).agg(*aggs).withColumn("missing", F.lit(True))
    filled = rows.filter(F.col("status").isNotNull()).agg(*aggs).withColumn("missing", F.lit(False))
    return missing.unionByName(filled)


@query(
    "filter_regex",
    """select p_partkey, p_name from part
       where regexp_matches(p_name, 'red|bolt$') and not regexp_matches(p_name, '^small')""",
)
def filter_regex(t: Tables):
    return t.part.filter(matches_any("p_name", ["red", "bolt$"]) & ~matches_any("p_name", ["^small"])).select(
        "p_partkey", "p_name"
    )


@query(
    "filter_range",
    """select l_orderkey, l_linenumber, l_quantity, l_discount from lineitem
       where l_quantity between 10 and 20 and l_discount > 0.02 and l_discount <= 0.06""",
)
def filter_range(t: Tables):
    return t.lineitem.filter(
        F.col("l_quantity").between(10, 20) & (F.col("l_discount") > 0.02) & (F.col("l_discount") <= 0.06)
    ).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query(
    "filter_datepart",
    """select o_orderkey, o_orderdate::date as day from orders
       where year(o_orderdate)::varchar >= '1998' and year(o_orderdate) <= 2000 and month(o_orderdate) = 7""",
)
def filter_datepart(t: Tables):
    """Years as a range that reaches the scan; the month cannot be a range."""
    day = F.col("o_orderdate")
    years = (day >= F.lit("1998-01-01").cast("timestamp_ntz")) & (day < F.lit("2001-01-01").cast("timestamp_ntz"))
    return t.orders.filter(years & (F.month(day) == 7)).select("o_orderkey", day.cast("date").alias("day"))


@query(
    "filter_compound_exclude",
    """select o_orderkey, status, o_orderpriority
       from (select o_orderkey, nullif(o_orderstatus, 'P') as status, o_orderpriority from orders)
       where not coalesce((status = 'F' and o_orderpriority = '1-URGENT') or (status = 'O' and o_orderpriority = '5-LOW'),
                          false)""",
)
def filter_compound_exclude(t: Tables):
    rows = t.orders.select("o_orderkey", null_if("o_orderstatus", "P").alias("status"), "o_orderpriority")
    return filters.exclude_pairs(rows, "status", "o_orderpriority", [("F", "1-URGENT"), ("O", "5-LOW")])


@query(
    "param_metric",
    """select o_orderkey, o_orderpriority, o_totalprice as value from orders
       where o_orderpriority = '2-HIGH' and o_orderstatus in ('F', 'O')""",
)
def param_metric(t: Tables):
    """A view's parameters: which column is the measure, and which rows are shown."""
    rows = filters.where_equal(
        t.orders, ["o_orderpriority", "o_orderstatus"], o_orderpriority="2-HIGH", o_orderstatus=["F", "O"]
    )
    return project.select_metric(
        rows, ["o_orderkey", "o_orderpriority"], "o_totalprice", ["o_totalprice", "o_custkey"]
    )


@query(
    "drop_any_null",
    """select d.doc_id, d.lang, l.quality, l.toxic from documents d left join labels l using (doc_id)
       where l.quality is not null and l.toxic is not null""",
)
def drop_any_null(t: Tables):
    rows = joins.left_join(t.documents.select("doc_id", "lang"), t.labels, "doc_id")
    return filters.drop_any_null(rows)


@query(
    "fill_nulls",
    """select o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'none') as status,
              coalesce(nullif(o_custkey % 10, 0), -1) as digit,
              coalesce(case when o_orderpriority <> '5-LOW' then o_totalprice end, 0) as amount
       from orders""",
)
def fill_nulls(t: Tables):
    """Missing values per column: a number fill does not touch text columns."""
    rows = t.orders.select(
        "o_orderkey",
        null_if("o_orderstatus", "P").alias("status"),
        null_if(F.col("o_custkey") % 10, 0).alias("digit"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("amount"),
    )
    return rows.withColumns({"status": fill_null("status", "none"), "digit": fill_null("digit", -1)}).fillna(0)


@query(
    "sentinel_numeric",
    """select o_orderkey, case when o_orderstatus <> 'F' then o_totalprice end as estimate from orders""",
)
def sentinel_numeric(t: Tables):
    """``.`` stands for a missing number."""
    text = F.when(F.col("o_orderstatus") == "F", ".").otherwise(F.concat(F.lit(" "), F.col("o_totalprice")))
    return t.orders.select("o_orderkey", sentinel_number(text).alias("estimate"))


@query(
    "rows_at_extreme",
    """select l_orderkey, l_linenumber, 'max' as kind, l_quantity from lineitem
       where l_returnflag = 'A' and l_quantity = (select max(l_quantity) from lineitem where l_returnflag = 'A')
       union all
       select l_orderkey, l_linenumber, 'min', l_quantity from lineitem
       where l_returnflag = 'A' and l_quantity = (select min(l_quantity) from lineitem where l_returnflag = 'A')""",
)
def rows_at_extreme(t: Tables):
    rows = t.lineitem.filter(F.col("l_returnflag") == "A").select("l_orderkey", "l_linenumber", "l_quantity")
    top = filters.at_extreme(rows, "l_quantity", "max").withColumn("kind", F.lit("max"))
    low = filters.at_extreme(rows, "l_quantity", "min").withColumn("kind", F.lit("min"))
    return top.unionByName(low)
