"""Market, tax, forecast, residential sales and headline jobs on tables in the published layouts."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiolume.catalog import jobs_people, jobs_travel
from regiolume.catalog.jobs_people import pick, sql_list
from regiolume.catalog.registry import YEARS_SQL, Tables, query
from regiolume.operators.series import Event
from regiolume.operators.setops import stack
from regiolume.plans import employment, forecast, headlines, market, population, residential, rules, tax, travel
from regiolume.session import scratch_folder
from regiolume.schema import ASSESSOR_LAYOUTS, PIERCE_SALES_COLUMNS
from regiolume.sources import read_layout, write_report
from regiolume.sources.delimited import QUOTED

# Home sales and rents --------------------------------------------------------------------------


@query(
    "job_market_series",
    """with m as (select date_trunc('month', o_orderdate)::date as month, max(o_totalprice) as price, count(*)::double as sold,
                         count(distinct o_custkey)::double as stock from orders group by 1)
       select month, 'Median Sales Price' as variable, price as value from m
       union all select month, 'Homes Sold', sold from m union all select month, 'Home Inventory', stock from m""",
)
def job_market_series(t: Tables):
    wide = t.orders.groupBy(F.date_format("o_orderdate", "MMM-yy").alias("Month.of.Period.End")).agg(
        F.max("o_totalprice").alias("Median.Sale.Price"), F.count("*").alias("Homes.Sold"),
        F.countDistinct("o_custkey").alias("Inventory"),
    )
    return market.home_sales(wide)


def rent_table(t: Tables) -> DataFrame:
    heads = [f"{y}-{m:02d}" for y in t.years() for m in range(1, 13)]
    sales = t.orders.groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("head")).agg(
        F.max("o_totalprice").alias("top")
    )
    placed = sales.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    wide = placed.groupBy("c_nationkey").pivot("head", heads).agg(F.max("top"))
    return wide.select(
        F.col("c_nationkey").alias("RegionID"), F.concat(F.lit("Town "), F.col("c_nationkey")).alias("RegionName"),
        F.lit(1).alias("SizeRank"), *[F.col(f"`{h}`") for h in heads],
    )


@query(
    "job_rents",
    f"""with r as (select date_trunc('month', o_orderdate)::date as month, max(o_totalprice) as estimate
                  from orders join customer on o_custkey = c_custkey where c_nationkey = 3 group by 1),
            m as (select make_date(y, m, 1) as month from (select unnest({YEARS_SQL}) as y), (select unnest(range(1, 13)) as m))
       select 'Town 3' as region, month, estimate from m left join r using (month)""",
)
def job_rents(t: Tables):
    return market.rents(rent_table(t), "Town 3")


# Retail sales tax ------------------------------------------------------------------------------


def tax_table(t: Tables) -> DataFrame:
    """A label row per place, below it one row per quarter and tax type; blanks stand for missing cells."""
    key = F.col("c_nationkey")
    suffix = F.when(key < 10, "/king").when(key < 20, "/pierce").otherwise("")
    place = F.concat(F.lit("Town "), key % 10, suffix)
    sales = t.orders.groupBy(
        "o_custkey", (F.year("o_orderdate") + 20).alias("y"), F.quarter("o_orderdate").alias("q"), "o_orderstatus"
    ).agg(F.count("*").alias("n"))
    placed = sales.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    kind = F.when(F.col("o_orderstatus") == "F", "Sales").otherwise("Use")
    cells = placed.groupBy(key, place.alias("place"), "y", "q", kind.alias("kind")).agg(F.sum("n").alias("n"))
    blank = F.lit(" ")
    quarters = cells.select(
        (key * 100_000 + F.col("y") * 40 + F.col("q") * 10 + F.when(F.col("kind") == "Sales", 1).otherwise(2)).alias("pos"),
        F.concat(F.col("y"), F.lit(" Quarter "), F.col("q")).alias("Year"), F.col("kind").alias("Tax.Type"),
        F.lit("44").alias("NAICS"), F.lit("9").alias("Units"), F.col("n").cast("string").alias("Total.Taxable"),
    )
    labels = cells.groupBy(key, "place").agg(F.count("*").alias("rows")).select(
        (key * 100_000).alias("pos"), F.col("place").alias("Year"), blank.alias("Tax.Type"), blank.alias("NAICS"),
        blank.alias("Units"), blank.alias("Total.Taxable"),
    )
    return labels.unionByName(quarters)


TAX_SQL = """
  tax as (select 'Town ' || (c_nationkey % 10) || case when c_nationkey < 10 then '/king' when c_nationkey < 20 then '/pierce' else '' end as geography,
                 (date_trunc('quarter', o_orderdate) + interval 20 year)::date as quarter,
                 case o_orderstatus when 'F' then 'Sales' else 'Use' end as tax_type, count(*)::double as total
          from orders join customer on o_custkey = c_custkey group by 1, 2, 3)"""


def tax_sales(t: Tables) -> DataFrame:
    # Eight places to a block: the fill of a long file runs in pieces.
    return tax.quarterly_sales(tax_table(t), block=F.floor(F.col("pos") / 800_000))


@query("job_sales_tax", f"with {TAX_SQL} select geography, quarter, tax_type, total from tax")
def job_sales_tax(t: Tables):
    return tax_sales(t)


@query("job_sales_tax_region", f"with {TAX_SQL} select quarter, tax_type, sum(total) as total from tax group by 1, 2")
def job_sales_tax_region(t: Tables):
    return tax.region_sales(tax_sales(t))


@query(
    "job_sales_tax_city",
    f"""with {TAX_SQL},
       p as (select geography, sum(total) filter (quarter = date '2016-01-01') as a, sum(total) filter (quarter = date '2020-01-01') as b
             from tax where tax_type = 'Sales' group by 1),
       g as (select regexp_replace(geography, '/(king|pierce|snohomish)', '') as geography, a, b from p where a is not null),
       s as (select geography, case when count(a) = count(*) then sum(a) end as base,
                    case when count(b) = count(*) then sum(b) end as current from g group by 1),
       c as (select *, case when substr(geography, 6)::int < 5 then ['Metro', 'Core', 'HCT', 'CitiesTowns', 'Metro'][substr(geography, 6)::int + 1]
                            else 'Unincorporated County' end as class_desc from s)
       select geography, base, current, current / nullif(base, 0) as ratio, class_desc,
              list_position(['Metro', 'Core', 'HCT', 'CitiesTowns', 'Unincorporated County'], class_desc)::int as place_in_order from c""",
)
def job_sales_tax_city(t: Tables):
    """Parts of a place are summed after their county suffix is gone; unknown places are a class."""
    key = F.col("n_nationkey")
    cities = t.nation.filter(key < 5).select(
        F.concat(F.lit("Town "), key).alias("city_name"), pick(key, ("Metro", "Core", "HCT", "CitiesTowns", "Metro")).alias("class_desc")
    )
    return tax.city_ratios(tax_sales(t), cities, "2016-01-01", "2020-01-01")


# Forecast --------------------------------------------------------------------------------------

METRICS = (
    "Employment (thous.)", "Unemployment rate (%)", "Other income", "Per capita personal income ($)", "Not in any list",
)
# Heads as a binary round trip leaves them.
BROKEN_HEADS = {"1996.1": "1996.0999999999999", "1997.4": "1997.4000000000001"}


def forecast_table(t: Tables) -> DataFrame:
    """One row per metric, one column per quarter."""
    heads = [f"{y}.{q}" for y in t.years() for q in (1, 2, 3, 4)]
    rows = t.orders.groupBy(
        "o_orderpriority", F.concat(F.year("o_orderdate"), F.lit("."), F.quarter("o_orderdate")).alias("head")
    ).agg(F.sum(F.col("o_custkey")).alias("n"))
    wide = rows.groupBy("o_orderpriority").pivot("head", heads).agg(F.sum("n"))
    metric = F.lit(None).cast("string")
    for priority, name in zip(("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"), METRICS):
        metric = F.when(F.col("o_orderpriority") == priority, name).otherwise(metric)
    return wide.select(
        metric.alias("Metric"), F.lit("note").alias("Note"),
        *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).cast("double").alias(BROKEN_HEADS.get(h, h)) for h in heads],
    )


FORECAST_SQL = f"""
  fo as (select {sql_list(METRICS)}[substr(o_orderpriority, 1, 1)::int] as metric, date_trunc('quarter', o_orderdate)::date as quarter,
                sum(o_custkey)::double as v from orders group by 1, 2),
  fg as (select metric, make_date(y, q * 3 - 2, 1) as quarter from (select distinct metric from fo), (select unnest({YEARS_SQL}) as y),
                (select unnest(range(1, 5)) as q)),
  fv as (select metric, quarter, coalesce(v, 0) as v from fg left join fo using (metric, quarter)),
  forecast as (select metric, quarter, case metric when 'Employment (thous.)' then v * 1000 when 'Unemployment rate (%)' then v / 100
                      when 'Other income' then v * 1000000000 when 'Per capita personal income ($)' then v end as estimate from fv)"""

DIPS = (
    Event("first", "1995-10-01", end="1998-10-01"),
    Event("second", "1997-04-01", with_peak=True, search_from="1997-10-01"),
    Event("third", "1999-01-01", below_peak=False, end="2000-07-01"),
)

DIPS_SQL = f"""{FORECAST_SQL},
  e(event, peak, until, with_peak, below_peak, search_from) as (values
    ('first', date '1995-10-01', date '1998-10-01', false, true, date '1995-10-01'),
    ('second', date '1997-04-01', null, true, true, date '1997-10-01'),
    ('third', date '1999-01-01', date '2000-07-01', false, false, date '1999-01-01')),
  s as (select quarter, estimate from forecast where metric = 'Employment (thous.)'),
  l as (select e.*, round_even(estimate, -1) as level from e join s on quarter = peak)"""


@query("job_forecast_units", f"with {FORECAST_SQL} select * from forecast")
def job_forecast_units(t: Tables):
    return forecast.forecast(forecast_table(t))


@query(
    "job_recession_curves",
    f"""with {DIPS_SQL}
       select event, quarter, estimate, row_number() over (partition by event order by quarter)::int as index
       from s join l on quarter >= peak and (with_peak or quarter > peak) and (not below_peak or estimate <= level)
                        and (until is null or quarter <= until)""",
)
def job_recession_curves(t: Tables):
    return forecast.recession_curves(forecast.forecast(forecast_table(t)), DIPS)


@query(
    "job_years_to_recover",
    f"""with {DIPS_SQL},
       n as (select event, min(quarter) filter (estimate < level) as dip from l join s on quarter >= peak group by 1),
       r as (select event, any_value(peak) as peak, any_value(level) as level,
                    min(quarter) filter (quarter > dip and estimate >= level) as strict_return,
                    min(quarter) filter (quarter >= search_from and estimate >= level) as legacy_return
             from l join s on quarter >= peak join n using (event) group by 1)
       select 'sane' as rule, event, peak, level, strict_return as returned,
              round_even(datediff('day', peak, strict_return) * 86400.0 / 31536000, 1)::double as years from r
       union all
       select 'legacy', event, peak, level, legacy_return,
              round_even(datediff('day', peak, legacy_return) * 86400.0 / 31536000, 1)::double from r""",
)
def job_years_to_recover(t: Tables):
    data = forecast.forecast(forecast_table(t))
    sane = forecast.years_to_recover(data, DIPS).withColumn("rule", F.lit("sane"))
    return stack(sane, forecast.years_to_recover(data, DIPS, legacy=True).withColumn("rule", F.lit("legacy")))


# Residential sales -----------------------------------------------------------------------------

OCCUPANCIES = (
    "Single Family Residential", "Duplex", "Condo High Rise", "Apartment High Rise", "Mobile or Manufactured Home",
    "Condo Low Rise", "Warehouse", "Single Family Residential ",
)


def _sales_columns(t: Tables, county: int) -> DataFrame:
    """Every fourth customer's orders belong to one county; prices are coarse so that bulk sales occur."""
    day = F.add_months(F.col("o_orderdate").cast("date"), 240)
    return t.orders.filter(F.col("o_custkey") % 4 == county).select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), day.alias("day"),
        (F.floor(F.col("o_totalprice") / 100_000) * 100_000).cast("bigint").alias("price"),
        F.concat(F.lit("BUYER "), F.col("o_custkey") % 3).alias("buyer"),
    )


def assessor_tables(t: Tables) -> dict[str, DataFrame]:
    """The counties' tables as their deliveries hold them."""

    def parcel(c: str) -> list[Column]:
        return [F.lpad(F.col(c), 6, "0").alias("major"), F.lpad(F.col(c) % 100, 4, "0").alias("minor")]

    king, kitsap, pierce, snohomish = (_sales_columns(t, i) for i in range(4))
    two = kitsap.select(
        F.col("c").cast("string").alias("p"), F.date_format("day", "M/d/yyyy").alias("d"), "price", F.year("day").alias("y")
    )
    return {
        "king_sales": king.select(
            *parcel("c"), F.date_format("day", "MM/dd/yyyy").alias("documentdate"), F.col("price").cast("double").alias("saleprice"),
            F.col("buyer").alias("buyername"), (F.col("k") % 20).cast("int").alias("propertytype"),
            (F.col("k") % 5 * 2).cast("int").alias("principaluse"),
        ),
        "king_condo_units": t.customer.select(*parcel("c_custkey"), (F.col("c_custkey") % 28 / 4).cast("int").alias("unittype")),
        "king_condo_complexes": t.customer.filter(F.col("c_custkey") % 8 == 0).select(
            F.lpad("c_custkey", 6, "0").alias("major"), (F.col("c_custkey") % 5).cast("int").alias("constrclass")
        ),
        # Two deliveries that overlap from 2017 to 2019.
        "kitsap_sales_early": two.filter(F.col("y") <= 2019).select(
            F.col("p").alias("acct_no"), F.col("d").alias("sale_dt"), F.col("price").cast("double").alias("price")
        ),
        "kitsap_sales_late": two.filter(F.col("y") >= 2017).select(
            F.col("p").alias("tax parcel no."), F.col("d").alias("sale dt"), F.format_number("price", 0).alias("price")
        ),
        "kitsap_parcels": t.customer.filter(F.col("c_custkey") % 9 != 0).select(
            F.col("c_custkey").cast("string").alias("acct_no"), (F.col("c_custkey") % 45 + 108).cast("int").alias("property_class")
        ),
        "pierce_sales": pierce.select(
            F.col("c").cast("string").alias("parcel_number"), F.date_format("day", "MM/dd/yyyy").alias("sale_date"),
            F.col("price").alias("sale_price"), F.col("buyer").alias("grantee"),
        ),
        "pierce_improvements": stack(*[
            t.customer.select(
                F.col("c_custkey").cast("string").alias("parcel_number"),
                pick(F.col("c_custkey") % 3, ("Residential", "Out Building", "Commercial")).alias("property_type"),
                pick((F.floor(F.col("c_custkey") / 4) + i) % 8, OCCUPANCIES).alias("occupancy_description"),
            )
            for i in (0, 2)
        ]),
        "snohomish_sales": snohomish.select(
            F.col("c").cast("string").alias("parcel_id"), (F.col("k") % 50 + 100).cast("int").alias("prop_class"),
            F.when(F.col("k") % 13 != 0, "1 MAIN ST").alias("propertystreet"), F.date_format("day", "M-d-yy").alias("sale_date"),
            F.format_number("price", 0).alias("sale_price"), F.col("buyer").alias("ownername1"),
        ),
    }


def sales_of(held: dict[str, DataFrame], legacy: bool = False) -> DataFrame:
    return residential.regional_sales(
        residential.king_sales(held["king_sales"], held["king_condo_units"], held["king_condo_complexes"], legacy=legacy),
        residential.kitsap_sales(held["kitsap_sales_early"], held["kitsap_sales_late"], held["kitsap_parcels"]),
        residential.pierce_sales(held["pierce_sales"], held["pierce_improvements"]),
        residential.snohomish_sales(held["snohomish_sales"]),
    )


@query(
    "job_king_buildings",
    """with b as (select lpad((l_orderkey % 500)::varchar, 6, '0') as major, lpad((l_orderkey % 7)::varchar, 4, '0') as minor,
                         l_linenumber % 4 as units, l_quantity % 9 as sqft, nullif((l_suppkey % 6) * 10, 50)::varchar as zip from lineitem)
       select major, minor, max(units)::int as units, max(sqft)::double as sqft, max(zip) as zipcode from b
       where units <> 0 and sqft <> 0 and (zip is null or zip <> '0') group by 1, 2""",
)
def job_king_buildings(t: Tables):
    """Largest size, units and zip code of each parcel, from several buildings a parcel."""
    buildings = t.lineitem.select(
        F.concat(F.lpad(F.col("l_orderkey") % 500, 6, "0"), F.lit(" ")).alias("major"), F.lpad(F.col("l_orderkey") % 7, 4, "0").alias("minor"),
        (F.col("l_linenumber") % 4).cast("int").alias("nbrlivingunits"), (F.col("l_quantity") % 9).cast("int").alias("sqfttotliving"),
        F.nullif((F.col("l_suppkey") % 6 * 10).cast("string"), F.lit("50")).alias("zipcode"),
    )
    return residential.king_buildings(buildings).withColumn("sqft", F.col("sqft").cast("double"))


def all_sales(t: Tables) -> DataFrame:
    return sales_of(assessor_tables(t))


SALES_SQL = f"""
  o as (select o_orderkey as k, o_custkey as c, (o_orderdate + interval 240 month)::date as day,
               (floor(o_totalprice / 100000) * 100000)::bigint as price, o_custkey % 3 as buyer, o_custkey % 4 as county
        from orders),
  y as (select * from o where year(day) between 2016 and 2021),
  k1 as (select *, count(*) over (partition by day, price, buyer) as n from y
         where county = 0 and price <> 0 and k % 20 <> 0 and (k % 5) * 2 in (2, 4, 6, 8)),
  k2 as (select *, (k % 5) * 2 as use, (c % 28 / 4.0) as raw from k1 where n = 1 and k % 20 <= 15),
  k3 as (select *, case when trunc(raw) in (1, 2, 3, 4) then trunc(raw) else 0 end as condo,
                case when c % 8 = 0 and c % 5 <= 2 then 1 else 0 end as dense from k2),
  king as (select lpad(c::varchar, 6, '0') || '-' || lpad((c % 100)::varchar, 4, '0') as parcel_number, day, price,
                  case when dense = 1 then 6 when condo in (1, 3) then 5 when condo in (2, 4) then 4
                       when use = 6 and condo > 0 then 4 when use < 6 then 4 when use = 8 then 1 else 2 end as housing_type,
                  'king' as county from k3),
  kitsap as (select c::varchar as parcel_number, day, price, p as housing_type, 'kitsap' as county from (
               select *, c % 45 + 108 as pc, case when pc in (118, 119, 150) then 1 when pc = 111 then 2 when pc between 131 and 138 then 3
                      when pc between 121 and 123 then 4 when pc = 141 then 5 else 0 end as p
               from y where county = 1 and c % 9 <> 0) where pc between 1 and 150),
  occ as (select unnest(range(0, 8)) as i, unnest([2, 4, 6, 3, 1, 5, null, 2]) as ht),
  imp as (select c_custkey as c, max(ht) as ht from customer join occ on i = (c_custkey // 4) % 8 or i = (c_custkey // 4 + 2) % 8
          where c_custkey % 3 <> 1 group by 1),
  p1 as (select y.*, ht, count(*) over (partition by day, price, buyer) as n from y join imp using (c) where county = 2 and ht is not null),
  pierce as (select c::varchar as parcel_number, day, price, ht as housing_type, 'pierce' as county from p1 where n = 1),
  s1 as (select *, k % 50 + 100 as pc, count(*) over (partition by day, price, buyer) as n from y
         where county = 3 and k % 50 + 100 between 110 and 145 and k % 13 <> 0),
  snohomish as (select c::varchar as parcel_number, day, price,
                       case when pc between 117 and 119 then 1 when pc between 110 and 115 then 2 when pc between 130 and 139 then 3
                            when pc = 116 or pc between 121 and 124 then 4 when pc between 141 and 145 then 5 else 0 end as housing_type,
                       'snohomish' as county from s1 where n = 1),
  sales as (select parcel_number, month(day)::int as month, year(day)::int as year, price::double as sale_price,
                   case when price < 2500000 then (price // 50000 + 1)::int else 0 end as price_bin, housing_type::int as housing_type, county
            from (select * from king union all select * from kitsap union all select * from pierce union all select * from snohomish))"""


@query("job_residential_sales", f"with {SALES_SQL} select * from sales")
def job_residential_sales(t: Tables):
    """Four county layouts normalised, de-bulked, classified and binned."""
    return all_sales(t)


def _deliver(df: DataFrame, name: str, folder: str) -> None:
    """A table written in its delivery's layout: further columns, another order, names in capitals."""
    layout = ASSESSOR_LAYOUTS[name]
    if layout.order:
        rows = df.select(*[F.col(c) if c in df.columns else F.lit("é").alias(c) for c in layout.order])
    else:
        rows = df.select(F.lit("unused, é").alias("Extra"), *[F.col(f"`{c}`").alias(c.upper()) for c in reversed(df.columns)])
    rows.write.option("sep", layout.sep).option("encoding", layout.encoding).option("header", not layout.order).options(**QUOTED).csv(folder)


def _delivered(t: Tables) -> dict[str, str]:
    folders = {}
    for name, df in assessor_tables(t).items():
        folders[name] = scratch_folder(t.spark, name)
        _deliver(df, name, folders[name])
    return folders


@query("job_residential_files", f"with {SALES_SQL} select * from sales")
def job_residential_files(t: Tables):
    """The same sales from files in the four counties' layouts: separators, encodings, headers or none."""
    held = {name: read_layout(t.spark, folder, ASSESSOR_LAYOUTS[name])[0] for name, folder in _delivered(t).items()}
    return sales_of(held)


@query(
    "src_rejected_lines",
    """select case when o_orderkey % 7 = 0 then 'cells' when o_orderkey % 5 = 0 then 'key parcel_number' when o_orderkey % 3 = 0 then 'type sale_price'
              else 'row' end as reason, count(*) as n, sum(o_orderkey)::bigint as keys from orders group by 1""",
)
def src_rejected_lines(t: Tables):
    """Every line of a delivery is a row or in the table of rejected lines, with the reason."""
    k = F.col("o_orderkey")
    cells = {"parcel_number": F.when(k % 5 != 0, k.cast("string")), "etn": k.cast("string"), "sale_price": F.when(k % 3 == 0, "n/a").otherwise("1e3"),
             "sale_date": F.lit("1/2/2020"), "grantee": F.lit("Müller, \"A\"")}
    line = F.concat_ws("|", *[F.coalesce(cells.get(c, F.lit("")), F.lit("")) for c in PIERCE_SALES_COLUMNS])
    folder = scratch_folder(t.spark, "rejects")
    t.orders.select(F.when(k % 7 == 0, F.concat(line, F.lit("|more"))).otherwise(line)).write.option("encoding", "ISO-8859-1").text(folder)
    layout = dataclasses.replace(ASSESSOR_LAYOUTS["pierce_sales"], columns=ASSESSOR_LAYOUTS["pierce_sales"].columns | {"etn": "bigint"}, encoding="UTF-8")
    good, rejected = read_layout(t.spark, folder, layout)
    etn = F.split("line", "\\|")[0].cast("bigint")
    both = good.select(F.lit("row").alias("reason"), F.col("etn").alias("k")).unionByName(rejected.select("reason", etn.alias("k")))
    return both.groupBy("reason").agg(F.count("*").alias("n"), F.sum("k").alias("keys"))


@query(
    "job_sales_by_type",
    f"with {SALES_SQL} select year, housing_type, county, count(sale_price) as transactions from sales group by 1, 2, 3",
)
def job_sales_by_type(t: Tables):
    return residential.transactions_by_type(all_sales(t))


@query(
    "job_sales_by_bin",
    f"""with {SALES_SQL}
       select year, housing_type, price_bin, county, count(sale_price) as transactions from sales group by 1, 2, 3, 4""",
)
def job_sales_by_bin(t: Tables):
    return residential.transactions_by_type_and_bin(all_sales(t))


@query(
    "job_sales_summaries",
    f"""with {SALES_SQL}
       select year, housing_type, county, median(sale_price) as "median-sales-price" from sales group by 1, 2, 3""",
)
def job_sales_summaries(t: Tables):
    """Exact median price by type."""
    return residential.median_price_by_type(all_sales(t))


@query(
    "job_sales_report",
    f"""with {SALES_SQL}
       select 'total_residential_sales_transactions_region' as sheet, count(*) as n from sales
       union all select 'summarized_transactions_by_year_type_region', count(*) from (select distinct year, housing_type, county from sales)
       union all select 'summarized_transactions_by_year_type_price_region', count(*)
                 from (select distinct year, housing_type, price_bin, county from sales)
       union all select 'median_price_by_type_region', count(*) from (select distinct year, housing_type, county from sales where sale_price is not null)""",
)
def job_sales_report(t: Tables):
    """The four tables of the report, written below one root and read back."""
    folders = write_report(residential.sales_report(all_sales(t)), scratch_folder(t.spark, "sales-report"))
    return stack(*[
        t.spark.read.parquet(folder).agg(F.count("*").alias("n")).select(F.lit(name).alias("sheet"), "n")
        for name, folder in folders.items()
    ])


# Headline numbers ------------------------------------------------------------------------------

HEADLINE_SQL = f"""
  gy as (select year, sum(estimate) filter (variable = 'Migration') as mig, sum(estimate) filter (variable = 'Natural Increase') as nat,
                sum(estimate) filter (variable = 'Total Change') as tot from change where place = 'Region' group by 1),
  gl as (select max(year) as ly from gy),
  g1 as (select ly, round_even(mig + nat, -2) as ch, mig from gy, gl where year = ly),
  g2 as (select year, tot, mig from gy, gl where year > 2010 and year <> ly),
  g3 as (select max(tot) as top, max_by(year, tot) as ty, max_by(mig, tot) as tm from g2),
  growth_lines as (
    select 'latest year' as metric, ly::double as value from g1
    union all select 'population change', ch from g1
    union all select 'migration share of change', round_even(mig / nullif(ch, 0) * 100, 0) from g1
    union all select 'largest change', round_even(top, -2) from g3
    union all select 'year of largest change', ty from g3
    union all select 'migration share of largest change', round_even(tm / nullif(top, 0) * 100, 0) from g3
    union all select 'most similar year', year from g2, g1 where abs(tot - ch) = (select min(abs(tot - ch)) from g2, g1))"""


@query(
    "job_headlines",
    f"with {jobs_people.CHANGE_SQL}, {HEADLINE_SQL} select * from growth_lines",
)
def job_headlines(t: Tables):
    """The region's growth as single numbers, the most similar year with ties."""
    return headlines.growth_headlines(population.components_of_change(jobs_people.component_tables(t)))


@query(
    "job_headlines_places",
    f"""with {jobs_people.HOUSING_SQL},
       v as (select place, max(estimate) filter (year = 2016) as a, max(estimate) filter (year = 2021) as b
             from housing where variable = 'Total Housing Units' and (level = 5 or level = 1) group by 1),
       d as (select place, a, b - a as ch from v),
       r as (select ch as rc from d where place = 'Region'), m as (select ch as mc from d where place = 'Place 1')
       select 'units change, ' || place as metric, ch as value from d where place in ('Region', 'Place 1', 'Place 2', 'Place 3', 'Place 0')
       union all select 'units percent change, ' || place, round_even(ch / a * 100, 0) from d where place in ('Place 1', 'Place 2')
       union all select 'units share of region, Place 1', round_even(mc / nullif(rc, 0) * 100, 0) from m, r
       union all select 'units share of Place 1, Place 3', round_even(ch / nullif(mc, 0) * 100, 0) from d, m where place = 'Place 3'
       union all select 'units share of Place 1, all cities', round_even((select sum(ch) from d where place in ('Place 3', 'Place 0')) / nullif(mc, 0) * 100, 0) from m
       union all select * from (
         with u as (select variable, max(estimate) filter (year = 2016) as a, max(estimate) filter (year = 2020) as p, max(estimate) filter (year = 2021) as b
                    from housing where place = 'Region' group by 1),
              x as (select max(round_even(b - p, -2)) filter (variable = 'Total Housing Units') as t1,
                           max(round_even(b - a, -2)) filter (variable = 'Total Housing Units') as t2,
                           max(round_even(b - p, -2)) filter (variable = 'Two or More Housing Units') as m1,
                           max(round_even(b - a, -2)) filter (variable = 'Two or More Housing Units') as m2 from u)
         select 'new units, one year', t1 from x union all select 'new units, several years', t2 from x
         union all select 'multi-family units, one year', m1 from x union all select 'multi-family units, several years', m2 from x
         union all select 'multi-family share, one year', round_even(m1 / nullif(t1, 0) * 100, 0) from x
         union all select 'multi-family share, several years', round_even(m2 / nullif(t2, 0) * 100, 0) from x)""",
)
def job_headlines_places(t: Tables):
    units = population.housing_units(jobs_people.housing_table(t)).filter(F.col("level").isin(1, 5))
    places = headlines.place_headlines(
        units, "Total Housing Units", 2016, 2021, ["Place 3", "Place 0"], ["Place 1", "Place 2"], "Place 1", "units"
    )
    return stack(places, headlines.unit_headlines(units, 2016, 2020, 2021))


@query(
    "job_headlines_jobs",
    f"""with {jobs_people.SECTOR_SQL},
       r as (select month, jobs from jobs where geography = 'Region' and sector = 'Total Nonfarm'),
       a as (select max(jobs) filter (year(month) = 1998) as b, max(jobs) filter (year(month) = 1999) as w,
                    max(jobs) filter (year(month) = 2000) as l from r where month(month) = 10),
       s as (select max(jobs) as st from jobs where geography = 'Washington State' and sector = 'Total Nonfarm' and month = date '2000-10-01'),
       lo as (select min(jobs) as lj, min_by(month(month), jobs) as lm from r where year(month) = 1999),
       i as (select max(jobs) filter (year(month) = 1998) as b, max(jobs) filter (year(month) = 1999) as w,
                    max(jobs) filter (year(month) = 2000) as l from jobs
             where geography = 'Region' and sector = 'Information' and month(month) = 10),
       p as (select * from r where year(month) > 1995)
       select 'latest month' as metric, 10::double as value
       union all select 'jobs 1999 as percent of 1998', round_even(w / b * 100, 0) from a
       union all select 'jobs 2000 as percent of 1998', round_even(l / b * 100, 0) from a
       union all select 'region as percent of state 2000', round_even(l / nullif(st, 0) * 100, 0) from a, s
       union all select 'lowest jobs 1999', lj from lo union all select 'lowest month 1999', lm from lo
       union all select 'Information, change to 1999', round_even(w - b, -2) from i
       union all select 'Information, change to 2000', round_even(l - b, -2) from i
       union all select 'Information, percent change', round_even((l - b) / nullif(b, 0) * 100, 0) from i
       union all select 'month most similar to the lowest of 1999', year(month) * 100 + month(month) from p, lo
                 where year(month) < 1999 and abs(jobs - lj) = (select min(abs(jobs - lj)) from p, lo where year(month) < 1999)
       union all select 'month most similar to the latest of 2000', year(month) * 100 + month(month) from p, a
                 where year(month) < 2000 and abs(jobs - l) = (select min(abs(jobs - l)) from p, a where year(month) < 2000)""",
)
def job_headlines_jobs(t: Tables):
    jobs = employment.sector_jobs(jobs_people.sector_tabs(t))
    return headlines.job_headlines(jobs, 1998, 1999, 2000, ["Information"], after=1995)


@query(
    "job_headlines_airport",
    """with w as (select year(o_orderdate)::varchar as year, ((dayofyear(o_orderdate) - 1) // 7 + 1)::int as week, sum(o_custkey + 1)::double as v
                  from orders group by 1, 2),
            d as (select *, (date '2021-01-01' + ((week - 1) * 7)::int)::date as day from w),
            l as (select max(day) as day from d where year = '2000'),
            x as (select max(v) filter (year = '1998') as b, max(v) filter (year = '2000') as c, any_value(l.day) as day from d join l on d.day = l.day)
       select 'screenings 1998, latest week' as metric, b as value from x
       union all select 'screenings 2000, latest week', c from x
       union all select 'percent below base', round_even(1 - c / nullif(b, 0), 2) * 100 from x
       union all select 'latest week, month', month(day) from x union all select 'latest week, day', day(day) from x
       union all select 'lowest screenings', min(v) from d
       union all select 'lowest week, month and day', month(day) * 100 + day(day) from d where v = (select min(v) from d)""",
)
def job_headlines_airport(t: Tables):
    return headlines.airport_headlines(travel.weekly_screenings(jobs_travel.weekly_counts(t)), 1998, 2000)
