"""Scalar functions on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiolume.catalog.aggregates import customer_sales
from regiolume.catalog.registry import Tables, query
from regiolume.functions import dates, numbers, recode, text


@query(
    "str_replace_all",
    """select p_partkey, regexp_replace(p_name, '[aeiou]', '*', 'g') as masked,
              regexp_replace(p_name, ' ', '', 'g') as tight
       from part""",
)
def str_replace_all(t: Tables):
    return t.part.select(
        "p_partkey",
        text.replace_all("p_name", "[aeiou]", "*").alias("masked"),
        text.remove_all("p_name", " ").alias("tight"),
    )


@query(
    "str_replace_first",
    """select p_partkey, regexp_replace(p_name, '[aeiou]', '*') as masked,
              regexp_replace(p_name, 'e.*', '') as cut
       from part""",
)
def str_replace_first(t: Tables):
    return t.part.select(
        "p_partkey",
        text.replace_first("p_name", "[aeiou]", "*").alias("masked"),
        text.replace_first("p_name", "e.*", "").alias("cut"),
    )


# Substring steps in order; the second sees what the first made.
TYPE_STEPS = [("SMALL", "MINI ECONOMY"), ("ECONOMY", "BUDGET"), ("STANDARD", "PLAIN"), ("PLAIN", "PLAIN STANDARD")]


@query(
    "recode_chain",
    """select p_partkey,
              replace(replace(replace(replace(p_type, 'SMALL', 'MINI ECONOMY'), 'ECONOMY', 'BUDGET'),
                              'STANDARD', 'PLAIN'), 'PLAIN', 'PLAIN STANDARD') as kind
       from part""",
)
def recode_chain(t: Tables):
    return t.part.select("p_partkey", text.recode_chain("p_type", TYPE_STEPS).alias("kind"))


@query(
    "str_trim",
    """select p_partkey, ltrim('  ' || p_name || '  ') as lefty, trim('  ' || p_name || '  ') as both_sides,
              regexp_replace(p_name || '   x' , '\\s+', ' ', 'g') as squeezed
       from part""",
)
def str_trim(t: Tables):
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit("  "))
    return t.part.select(
        "p_partkey",
        text.trim_text(padded, "left").alias("lefty"),
        text.trim_text(padded).alias("both_sides"),
        text.squeeze(F.concat(F.col("p_name"), F.lit("   x"))).alias("squeezed"),
    )


@query(
    "str_sub",
    """select c_custkey, substr(c_name, 1, 4) as head, right(c_name, 8) as tail, substr(c_name, 6) as rest,
              length(c_name)::int as size
       from customer""",
)
def str_sub(t: Tables):
    return t.customer.select(
        "c_custkey",
        text.sub_text("c_name", 1, 4).alias("head"),
        text.sub_text("c_name", -8).alias("tail"),
        text.sub_text("c_name", 6).alias("rest"),
        F.length("c_name").alias("size"),
    )


@query(
    "concat_key",
    """select o_orderkey, strftime(o_orderdate, '%m_%d_%Y') || '_' || coalesce(nullif(o_orderstatus, 'P'), 'nan')
              || '_' || o_custkey as sales_id
       from orders""",
)
def concat_key(t: Tables):
    return t.orders.select(
        "o_orderkey",
        text.concat_key(
            [F.date_format("o_orderdate", "MM_dd_yyyy"), recode.null_if("o_orderstatus", "P"), "o_custkey"]
        ).alias("sales_id"),
    )


@query(
    "title_case",
    """select p_partkey, array_to_string([upper(w[1]) || w[2:] for w in string_split(lower(p_name), ' ')], ' ') as name,
              upper(left(p_type, 1)) || lower(p_type[2:]) as kind
       from part""",
)
def title_case(t: Tables):
    return t.part.select(
        "p_partkey", text.title_case("p_name").alias("name"), text.title_case("p_type").alias("kind")
    )


@query(
    "wrap_label",
    """select p_partkey,
              list_reduce(string_split(p_name, ' '), lambda acc, w: case
                when length(string_split(acc, chr(10))[-1]) + 1 + length(w) <= 10 then acc || ' ' || w
                else acc || chr(10) || w end) as narrow,
              list_reduce(string_split(p_name || ' ' || p_type || ' ' || p_brand, ' '), lambda acc, w: case
                when length(string_split(acc, chr(10))[-1]) + 1 + length(w) <= 20 then acc || ' ' || w
                else acc || chr(10) || w end) as wide
       from part""",
)
def wrap_label(t: Tables):
    """Greedy wrap of part names to 10 and 20 characters."""
    return t.part.select(
        "p_partkey",
        text.wrap_text("p_name", 10).alias("narrow"),
        text.wrap_text(F.concat_ws(" ", "p_name", "p_type", "p_brand"), 20).alias("wide"),
    )


def _balanced_sql(label: str, width: int) -> str:
    """Every way to break a label of a few words; the one with the least squared room."""
    line = "array_to_string(w[i + 1 : j], ' ')"
    return f"""
      select p_partkey, txt, row_number() over (partition by p_partkey order by cost, lines, starts) as choice from (
        with recursive s as (
          select p_partkey, string_split({label}, ' ') as w, 0::bigint as i, 0::bigint as cost, 0 as lines, []::bigint[] as starts, '' as txt from part
          union all
          select p_partkey, w, j, cost + case when j = len(w) then 0 else greatest({width} - length({line}), 0) ** 2 end::bigint,
                 lines + 1, list_prepend(i, starts), txt || case when i > 0 then chr(10) else '' end || {line}
          from s, unnest(range(i + 1, len(w) + 1)) as t(j) where length({line}) <= {width} or j = i + 1)
        select * from s where i = len(w))"""


@query(
    "wrap_balanced",
    f"""with a as ({_balanced_sql("p_name", 10)}), b as ({_balanced_sql("(p_name || ' ' || p_type || ' ' || p_brand || ' of size ' || p_size)", 16)})
       select p_partkey, a.txt as narrow, b.txt as wide from a join b using (p_partkey) where a.choice = 1 and b.choice = 1""",
)
def wrap_balanced(t: Tables):
    """Labels broken so that their lines are even."""
    label = F.concat_ws(" ", "p_name", "p_type", "p_brand", F.lit("of size"), "p_size")
    return t.part.select(
        "p_partkey", text.wrap_balanced("p_name", 10).alias("narrow"), text.wrap_balanced(label, 16).alias("wide")
    )


@query(
    "exact_map",
    """select n_nationkey, case n_name when 'NATION_1' then 'one' when 'NATION_2' then 'two' else 'other' end as label from nation""",
)
def exact_map(t: Tables):
    return t.nation.select(
        "n_nationkey", recode.exact_map("n_name", {"NATION_1": "one", "NATION_2": "two"}, "other").alias("label")
    )


@query(
    "format_label",
    """select o_orderkey, '$' || format('{:,}', round_even(o_totalprice, -2)::bigint) as price,
              format('{:,}', o_custkey * 1000) || ' people' as size
       from orders""",
)
def format_label(t: Tables):
    return t.orders.select(
        "o_orderkey",
        numbers.format_label("o_totalprice", -2, prefix="$").alias("price"),
        numbers.format_label("o_custkey", 0, suffix=" people", factor=1000.0).alias("size"),
    )


@query(
    "parse_number",
    "select o_orderkey, o_custkey * 1234 as whole, case when o_orderstatus = 'F' then null else o_custkey end as some from orders",
)
def parse_number(t: Tables):
    """Separators go; text that is no number gives NULL."""
    return t.orders.select(
        "o_orderkey",
        numbers.parse_number(F.format_number(F.col("o_custkey") * 1234, 0), "bigint").alias("whole"),
        numbers.parse_number(
            F.when(F.col("o_orderstatus") == "F", "n/a").otherwise(F.col("o_custkey").cast("string")), "bigint"
        ).alias("some"),
    )


@query(
    "parse_percent",
    "select l_orderkey, l_linenumber, (-(l_linenumber * 5))::double / 100 + 1 as index from lineitem",
)
def parse_percent(t: Tables):
    shown = F.concat(F.lit("-"), F.col("l_linenumber") * 5, F.lit("%"))
    return t.lineitem.select("l_orderkey", "l_linenumber", numbers.parse_percent(shown).alias("index"))


@query(
    "parse_dates",
    """select o_orderkey, o_orderdate::date as mdy, o_orderdate::date as mdy_short, o_orderdate::date as ymd,
              date_trunc('month', o_orderdate)::date as my, date_trunc('month', o_orderdate)::date as ym,
              null::date as bad,
              strptime('1-' || strftime(o_orderdate - interval 10 year, '%b-%y'), '%-d-%b-%y')::date as pivot
       from orders""",
)
def parse_dates(t: Tables):
    """Dates as text in several field orders, read back; ``Feb-85`` lies in the last century."""
    day = F.col("o_orderdate")
    earlier = F.add_months(day.cast("date"), -120)
    return t.orders.select(
        "o_orderkey",
        dates.parse_date(F.date_format(day, "M/d/yyyy"), "mdy").alias("mdy"),
        dates.parse_date(F.date_format(day, "MM-dd-yy"), "mdy").alias("mdy_short"),
        dates.parse_date(F.date_format(day, "yyyy-MM-dd"), "ymd").alias("ymd"),
        dates.parse_date(F.date_format(day, "MMM-yy"), "my").alias("my"),
        dates.parse_date(F.date_format(day, "yyyy-MM"), "ym").alias("ym"),
        dates.parse_date(F.col("o_orderpriority"), "mdy").alias("bad"),
        dates.parse_date(F.date_format(earlier, "MMM-yy"), "my").alias("pivot"),
    )


@query(
    "parse_quarter",
    """select o_orderkey, date_trunc('quarter', o_orderdate)::date as colon, date_trunc('quarter', o_orderdate)::date as blank,
              date_trunc('quarter', o_orderdate)::date as word, null::date as bad
       from orders""",
)
def parse_quarter(t: Tables):
    year, quarter = F.year("o_orderdate"), F.quarter("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        dates.parse_quarter(F.concat(year, F.lit(":Q"), quarter)).alias("colon"),
        dates.parse_quarter(F.concat(year, F.lit(" Q"), quarter)).alias("blank"),
        dates.parse_quarter(F.concat(year, F.lit(" Quarter "), quarter)).alias("word"),
        dates.parse_quarter("o_orderpriority").alias("bad"),
    )


@query(
    "date_parts",
    """select event_id, year(ts)::int as yr, month(ts)::int as mon, day(ts)::int as dom, hour(ts)::int as hr,
              strftime(ts, '%B') as month_name, strftime(ts, '%b') as month_short,
              strftime(ts, '%B-%Y') as label
       from events""",
)
def date_parts(t: Tables):
    return t.events.select(
        "event_id",
        F.year("ts").alias("yr"), F.month("ts").alias("mon"), F.dayofmonth("ts").alias("dom"), F.hour("ts").alias("hr"),
        dates.month_name("ts").alias("month_name"),
        dates.month_name("ts", short=True).alias("month_short"),
        dates.month_label("ts").alias("label"),
    )


@query(
    "week_to_date",
    """select o_orderkey, ((dayofyear(o_orderdate) - 1) // 7 + 1)::int as week,
              (date '2021-01-01' + ((dayofyear(o_orderdate) - 1) // 7 * 7)::int)::date as day
       from orders""",
)
def week_to_date(t: Tables):
    rows = t.orders.select("o_orderkey", dates.week_block("o_orderdate").alias("week"))
    return rows.withColumn("day", dates.week_to_date("week"))


@query(
    "common_year",
    """select o_orderkey, case when month(o_orderdate) = 2 and day(o_orderdate) = 29 then null
              else make_date(2021, month(o_orderdate), day(o_orderdate)) end as day
       from orders""",
)
def common_year(t: Tables):
    return t.orders.select("o_orderkey", dates.common_year("o_orderdate").alias("day"))


@query("anchor_date", "select o_orderkey, make_date(year(o_orderdate), 4, 1) as day from orders")
def anchor_date(t: Tables):
    return t.orders.select("o_orderkey", dates.anchor_date(F.year("o_orderdate")).alias("day"))


@query(
    "hour_label",
    """select event_id, hour(ts)::int as hr,
              case when hour(ts) < 12 then hour(ts) || 'AM' when hour(ts) = 12 then '12PM'
                   else (hour(ts) - 12) || 'PM' end as label,
              strftime(date_trunc('hour', ts), '%H:%M:%S') as clock
       from events""",
)
def hour_label(t: Tables):
    """``5am``-style text to the hour, and the hour to its label."""
    shown = F.when(F.hour("ts") == 12, "Noon").otherwise(F.lower(F.date_format("ts", "ha")))
    rows = t.events.select("event_id", dates.hour_of_label(F.concat(shown, F.lit("_ratio"))).alias("hr"))
    return rows.withColumns({"label": dates.hour_label("hr"), "clock": dates.clock("hr")})


@query(
    "case_when",
    """select p_partkey, case p_type when 'ECONOMY' then 'low' when 'PROMO' then 'low' when 'LARGE' then 'high' end as level,
              if(p_size > 25, 'big', 'small') as size
       from part""",
)
def case_when(t: Tables):
    kind, size = F.col("p_type"), F.col("p_size")
    return t.part.select(
        "p_partkey",
        recode.case_when([(kind.isin("ECONOMY", "PROMO"), "low"), (kind == "LARGE", "high")]).alias("level"),
        recode.case_when([(size > 25, "big")], "small").alias("size"),
    )


@query(
    "classify_category",
    """select p_partkey, p_size,
              case when p_type = 'PROMO' and p_size > 10 then 6 when p_size in (1, 3) then 5 when p_size in (2, 4) then 4
                   when p_size < 6 then 4 when p_size = 8 then 1 else 0 end as housing_type
       from part where p_type not in ('LARGE')""",
)
def classify_category(t: Tables):
    """Overwrite rules: the last one that matches wins."""
    size, kind = F.col("p_size"), F.col("p_type")
    rules = [
        (size == 8, 1), (size < 6, 4), (size.isin(2, 4), 4), (size.isin(1, 3), 5), ((kind == "PROMO") & (size > 10), 6)
    ]
    kept = t.part.filter(recode.not_in_keep_null("p_type", ["LARGE"]))
    return kept.select("p_partkey", "p_size", recode.last_match(rules, 0).alias("housing_type"))


@query(
    "threshold_bands",
    """select l_orderkey, l_linenumber,
              case when l_discount <= 0.025 then 'Severe' when l_discount <= 0.05 then 'Heavy'
                   when l_discount <= 0.075 then 'Moderate' when l_discount > 0.075 then 'Minimal' end as level
       from lineitem""",
)
def threshold_bands(t: Tables):
    upper = [(0.025, "Severe"), (0.05, "Heavy"), (0.075, "Moderate")]
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", numbers.bands("l_discount", upper, "Minimal").alias("level")
    )


@query(
    "price_bins",
    """select o_orderkey, case when o_totalprice >= 0 and o_totalprice < 400000
                               then floor(o_totalprice / 8000)::int + 1 else 0 end as price_bin
       from orders""",
)
def price_bins(t: Tables):
    return t.orders.select("o_orderkey", numbers.price_bin("o_totalprice", 8_000, 50).alias("price_bin"))


@query(
    "unit_scale",
    """select o_orderkey, case o_orderstatus when 'F' then o_custkey * 1000.0 when 'O' then o_custkey / 4.0 end as estimate
       from orders""",
)
def unit_scale(t: Tables):
    """Factor per class; a class without one gives NULL."""
    return t.orders.select(
        "o_orderkey",
        numbers.unit_scale(F.col("o_custkey").cast("double"), "o_orderstatus", {"F": 1000, "O": 0.25}).alias("estimate"),
    )


@query(
    "pct_change",
    """with y as (select c_nationkey, sum(case when year(o_orderdate) = 1996 then o_totalprice::decimal(18,2) end)::double as a,
                         sum(case when year(o_orderdate) = 2000 then o_totalprice::decimal(18,2) end)::double as b
                  from orders join customer on o_custkey = c_custkey group by 1)
       select c_nationkey, abs(b - a) as diff, (b - a) * 100 / nullif(a, 0) as pct, b * 100 / nullif(a, 0) as pct_of from y""",
)
def pct_change(t: Tables):
    rows = customer_sales(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    sums = rows.groupBy("c_nationkey").agg(*[
        F.sum(F.when(F.col("yr") == year, F.col("estimate"))).cast("double").alias(name)
        for name, year in (("a", 1996), ("b", 2000))
    ])
    return sums.select(
        "c_nationkey",
        F.abs(F.col("b") - F.col("a")).alias("diff"),
        numbers.pct_change("b", "a").alias("pct"),
        numbers.pct_of("b", "a").alias("pct_of"),
    )
