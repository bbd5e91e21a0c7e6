"""Readers and sinks: the benchmark tables are written in awkward layouts and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiolume import sources
from regiolume.catalog.registry import Tables, query
from regiolume.functions.numbers import money_sum
from regiolume.operators import setops
from regiolume.plans import claims
from regiolume.session import scratch_folder

MARK = "\ufeff"


@query("src_csv", "select o_orderkey, o_orderpriority, o_totalprice, o_orderdate::date as day from orders")
def src_csv(t: Tables):
    """Comma files that start with a byte-order mark, read with an explicit schema."""
    folder = scratch_folder(t.spark, "csv")
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"))
    sources.write_csv(rows.withColumnRenamed("o_orderkey", MARK + "o_orderkey"), folder)
    return sources.read_csv(
        t.spark, folder, "o_orderkey BIGINT, o_orderpriority STRING, o_totalprice DOUBLE, day DATE"
    )


@query(
    "src_delimited",
    """select lpad(c_custkey::varchar, 8, '0') as major, c_name || ' Café' as name, c_acctbal as balance, 'pipe' as layout from customer
       union all
       select lpad(s_suppkey::varchar, 8, '0'), s_name || ' Łódź', s_acctbal, 'tab' from supplier""",
)
def src_delimited(t: Tables):
    """Headerless pipe files in Latin-1 and tab files in UTF-16; keys keep their leading zeros."""
    pipe, tab = scratch_folder(t.spark, "pipe"), scratch_folder(t.spark, "tab")
    t.customer.select(
        F.lpad("c_custkey", 8, "0"), F.concat("c_name", F.lit(" Café")), "c_acctbal"
    ).write.option("sep", "|").option("encoding", "ISO-8859-1").csv(pipe)
    t.supplier.select(
        F.lpad("s_suppkey", 8, "0"), F.concat("s_name", F.lit(" Łódź")), "s_acctbal"
    ).write.option("sep", "\t").option("encoding", "UTF-16LE").option("lineSep", "\n").csv(tab)
    names = ["major", "name", "balance"]
    a = sources.read_delimited(t.spark, pipe, names, "|", "ISO-8859-1").withColumn("layout", F.lit("pipe"))
    b = sources.read_delimited(t.spark, tab, names, "\t", "UTF-16LE").withColumn("layout", F.lit("tab"))
    return setops.stack(a, b).withColumn("balance", F.col("balance").try_cast("double"))


@query(
    "src_files_tagged",
    """select o_orderkey, o_totalprice, year(o_orderdate)::int as year, o_orderpriority as area from orders""",
)
def src_files_tagged(t: Tables):
    """One folder per year and area, stacked in one scan; year and area come from the path."""
    folder = scratch_folder(t.spark, "tagged")
    t.orders.select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("data"), F.col("o_orderpriority").alias("tab")
    ).write.partitionBy("data", "tab").option("header", True).csv(folder)
    rows = sources.read_tagged(
        t.spark, folder, "o_orderkey BIGINT, o_totalprice DOUBLE", "year", r"data=(\d{4})", "int"
    )
    area = F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), "tab=([^/]+)", 1))
    return rows.withColumn("area", area)


@query(
    "src_named",
    """select s_suppkey, 'say "' || s_name || '", ok' as name, s_acctbal as balance from supplier""",
)
def src_named(t: Tables):
    """Some columns of a wide file by the names in its header; a value holds separators and doubled quotes."""
    folder = scratch_folder(t.spark, "named")
    wide = t.supplier.select(
        F.lit("x").alias("Unused"), F.col("s_acctbal").alias("BALANCE"),
        F.concat(F.lit('say "'), F.col("s_name"), F.lit('", ok')).alias("Name"), F.col("s_suppkey").alias("S_SuppKey"),
    )
    sources.write_csv(wide, folder)
    return sources.read_named(t.spark, folder, {"s_suppkey": "bigint", "name": "string", "balance": "double"})


def write_titled(df, lines, folder: str, titles: list[str], part) -> None:
    """Text files of bounded size that each start with title rows."""
    body = df.select(part.alias("part"), F.lit(len(titles)).alias("at"), lines.alias("line"))
    heads = body.select("part").distinct().select(
        "part", F.posexplode(F.array(*[F.lit(x) for x in titles])).alias("at", "line")
    )
    stacked = heads.unionByName(body).repartition("part").sortWithinPartitions("part", "at", "line")
    stacked.select("part", "line").write.partitionBy("part").text(folder)


@query(
    "src_skip_rows",
    """select lpad(c_custkey::varchar, 6, '0') as id, c_mktsegment as segment, c_acctbal as balance,
              (row_number() over (partition by c_custkey // 400 order by c_custkey))::bigint as pos from customer""",
)
def src_skip_rows(t: Tables):
    """Three title rows stand above the header; the line number is part of the result."""
    folder = scratch_folder(t.spark, "titled")
    line = F.concat_ws(",", F.lpad("c_custkey", 6, "0"), "c_mktsegment", "c_acctbal")
    titles = ["Customer balances,,", "Table 3,,", ",,", "Customer Id,Segment,Balance"]
    write_titled(t.customer, line, folder, titles, F.floor(F.col("c_custkey") / 400))
    rows = sources.read_below_titles(t.spark, folder, skip=3)
    return rows.select(
        F.col("`Customer.Id`").alias("id"), F.col("Segment").alias("segment"),
        F.col("Balance").try_cast("double").alias("balance"), "pos",
    )


@query(
    "src_tabs",
    """select 'customers' as tab, lpad(c_custkey::varchar, 6, '0') as id, c_mktsegment as segment, c_acctbal as balance from customer
       union all select 'suppliers', lpad(s_suppkey::varchar, 6, '0'), null, s_acctbal from supplier""",
)
def src_tabs(t: Tables):
    """Tabs staged as files: title rows above the header, one tab without a column of the other."""
    people, sellers = scratch_folder(t.spark, "tab-customers"), scratch_folder(t.spark, "tab-suppliers")
    line = F.concat_ws(",", F.lpad("c_custkey", 6, "0"), "c_mktsegment", "c_acctbal")
    write_titled(t.customer, line, people, ["Customers,,", ",,", "Id,Segment,Balance"], F.floor(F.col("c_custkey") / 400))
    line = F.concat_ws(",", F.lpad("s_suppkey", 6, "0"), "s_acctbal")
    write_titled(t.supplier, line, sellers, ["Suppliers,", ",", "Id,Balance"], F.floor(F.col("s_suppkey") / 400))
    rows = sources.read_tabs(t.spark, {"customers": people, "suppliers": sellers}, 2, "tab")
    return rows.select(
        "tab", F.col("Id").alias("id"), F.col("Segment").alias("segment"), F.col("Balance").try_cast("double").alias("balance")
    )


@query(
    "src_headers_differ",
    """select c_nationkey::varchar as tab, c_custkey as id,
              case when c_nationkey % 3 <> 2 then c_acctbal end as balance,
              c_mktsegment || ', "' || c_nationkey || '"' as segment,
              row_number() over (partition by c_nationkey order by c_custkey)::bigint as pos from customer""",
)
def src_headers_differ(t: Tables):
    """A file for each nation: columns in another order in some, one missing in others, titles above all."""
    folder = scratch_folder(t.spark, "headed")
    layout = F.col("c_nationkey") % 3
    segment = F.concat(F.lit('"'), "c_mktsegment", F.lit(', ""'), "c_nationkey", F.lit('"""'))
    by_layout = lambda a, b, c: F.when(layout == 0, a).when(layout == 1, b).otherwise(c)
    line = by_layout(
        F.concat_ws(",", "c_custkey", segment, "c_acctbal"), F.concat_ws(",", "c_acctbal", "c_custkey", segment),
        F.concat_ws(",", segment, "c_custkey"),
    )
    body = t.customer.select(F.col("c_nationkey").alias("tab"), (F.col("c_custkey") + 10).alias("at"), line.alias("line"))
    heads = t.customer.select("c_nationkey").distinct().select(
        F.col("c_nationkey").alias("tab"),
        F.posexplode(F.array(
            F.concat(F.lit("Nation "), "c_nationkey"), F.lit(",,"),
            by_layout(F.lit("Id,Segment Name,Balance"), F.lit('BALANCE,"ID",Segment  Name'), F.lit("segment name,id")),
        )).alias("at", "line"),
    )
    both = heads.unionByName(body).repartition("tab").sortWithinPartitions("tab", "at")
    both.select("tab", "line").write.partitionBy("tab").text(folder)
    return sources.read_headed(
        t.spark, folder, {"Id": "int", "Segment.Name": "string", "Balance": "double"}, skip=2, tag="tab",
        tag_value=F.regexp_extract("file", r"tab=(\d+)", 1),
    ).select("tab", F.col("Id").alias("id"), F.col("`Segment.Name`").alias("segment"), F.col("Balance").alias("balance"), "pos")


@query(
    "text_report_table",
    """select c_custkey as id, (c_custkey * 1000)::bigint as claims, (c_custkey % 2)::int as block from customer""",
)
def text_report_table(t: Tables):
    """Report text: title lines, runs of blanks, separators, two blocks side by side."""
    folder = scratch_folder(t.spark, "report")
    pairs = t.customer.groupBy(F.floor(F.col("c_custkey") / 2).alias("row")).agg(
        F.max(F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey"))).alias("a"),
        F.max(F.when(F.col("c_custkey") % 2 == 1, F.col("c_custkey"))).alias("b"),
    )
    cell = [F.lpad(F.format_number(x, 0), 18, " ") for x in (F.col("a"), F.col("a") * 1000, F.col("b"), F.col("b") * 1000)]
    titles = [f"  Report page line {i}" for i in range(6)]
    write_titled(pairs, F.concat(*cell), folder, titles, F.floor(F.col("row") / 100))
    lines = sources.numbered_lines(t.spark, folder)
    rows = sources.report_blocks(lines, 6, None, [[(0, "id"), (1, "claims")], [(2, "id"), (3, "claims")]])
    return rows.select(
        F.col("id").try_cast("bigint").alias("id"), F.col("claims").try_cast("bigint").alias("claims"), "block"
    )


@query(
    "job_weekly_claims",
    """with w as (select c_custkey as k, (date '2019-01-01' + (c_custkey % 360)::int)::date as old,
                         (date '2020-01-01' + (c_custkey % 360)::int)::date as new from customer),
            v as (select old as date, new as day, 'Initial Claims' as variable, (k * 1000)::double as value from w
                  union all select old, new, 'Weekly Change', -k from w union all select old, new, '4 Week Average', k * 10 from w
                  union all select new, new, 'Initial Claims', k * 1001 from w
                  union all select new, new, 'Weekly Change', k from w union all select new, new, '4 Week Average', k * 20 from w)
       select date, day, variable, value, year(date)::int as year from v""",
)
def job_weekly_claims(t: Tables):
    """Report text of two years side by side, longer than a page, with title and foot lines that are no week."""
    folder = scratch_folder(t.spark, "claims")
    k = F.col("c_custkey").cast("long")
    day = F.date_format(F.date_add(F.lit("2019-01-01").cast("date"), (k % 360).cast("int")), "M/d/yyyy")
    later = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (k % 360).cast("int")), "M/d/yyyy")
    cells = [day, F.format_number(k * 1000, 0), F.format_number(-k, 0), F.lit("0.5"), F.format_number(k * 10, 0),
             later, F.format_number(k * 1001, 0), F.format_number(k, 0), F.lit("-0.5"), F.format_number(k * 20, 0)]
    line = F.concat(F.lit("   "), F.concat_ws("   ", *cells))
    body = t.customer.select((k % 3).alias("part"), line.alias("line"), F.lit(1).alias("at"))
    ends = body.select("part").distinct().select("part", F.explode(F.array(
        F.struct(F.lit("  Weekly claims, page of the report").alias("line"), F.lit(0).alias("at")),
        F.struct(F.lit(" footnote 1 2 3 4").alias("line"), F.lit(2).alias("at")),
    )).alias("e")).select("part", "e.line", "e.at")
    both = body.unionByName(ends).repartition("part").sortWithinPartitions("part", "at", "line")
    both.select("part", "line").write.partitionBy("part").text(folder)
    return claims.weekly_claims(sources.numbered_lines(t.spark, folder), first=0)


@query("src_lower_names", "select r_regionkey as \"key\", r_name as name from region")
def src_lower_names(t: Tables):
    """Names of a file in capitals become small."""
    folder = scratch_folder(t.spark, "capitals")
    sources.write_csv(t.region.select(F.col("r_regionkey").alias("KEY"), F.col("r_name").alias("Name")), folder)
    return sources.lower_names(sources.read_csv(t.spark, folder, t.region.selectExpr("r_regionkey as KEY", "r_name as Name").schema))


@query(
    "report_versions",
    """select 1 as number, o_orderstatus as status, count(*) as n from orders group by 2
       union all select 2, o_orderstatus, count(*) from orders where o_totalprice > 100000 group by 2""",
)
def report_versions(t: Tables):
    """Two runs of a report below one root: the newest is read by default, the one before stays readable."""
    root = scratch_folder(t.spark, "versions")
    counts = lambda df: df.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
    sources.write_report({"by-status": counts(t.orders)}, root)
    sources.write_report({"by-status": counts(t.orders.filter("o_totalprice > 100000"))}, root)
    first, newest = sources.read_report(t.spark, root, 1), sources.read_report(t.spark, root)
    return setops.stack(*[
        tables["by-status"].withColumn("number", F.lit(n)) for n, tables in ((1, first), (2, newest))
    ])


@query("src_table", "select c_custkey, c_mktsegment from customer")
def src_table(t: Tables):
    """A table cut to the attribute columns asked for; the others are never read."""
    return sources.read_table(t.spark, t.path("customer"), ["c_custkey", "c_mktsegment"])


def _summary(t: Tables):
    return t.orders.groupBy(F.year("o_orderdate").alias("yr"), "o_orderpriority").agg(
        F.count("*").alias("transactions"), money_sum("o_totalprice").alias("amount")
    )


@query(
    "sink_csv_roundtrip",
    """select year(o_orderdate)::int as yr, o_orderpriority, count(*) as transactions,
              sum(o_totalprice::decimal(18,2))::double as amount from orders group by 1, 2""",
)
def sink_csv_roundtrip(t: Tables):
    folder = scratch_folder(t.spark, "sink")
    out = _summary(t)
    sources.write_csv(out, folder)
    return sources.read_csv(t.spark, folder, out.schema)


@query(
    "sink_report_roundtrip",
    """select 'by-year' as sheet, year(o_orderdate)::varchar as key, count(*) as n from orders group by 2
       union all select 'by-priority', o_orderpriority, count(*) from orders group by 2
       union all select 'by-status', o_orderstatus, count(*) from orders group by 2""",
)
def sink_report_roundtrip(t: Tables):
    """Several named tables under one root, read back by name."""
    keys = {"by-year": F.year("o_orderdate").cast("string"), "by-priority": F.col("o_orderpriority"),
            "by-status": F.col("o_orderstatus")}
    tables = {name: t.orders.groupBy(k.alias("key")).agg(F.count("*").alias("n")) for name, k in keys.items()}
    folders = sources.write_report(tables, scratch_folder(t.spark, "book"))
    return setops.stack(*[
        t.spark.read.parquet(path).withColumn("sheet", F.lit(name)) for name, path in folders.items()
    ])
