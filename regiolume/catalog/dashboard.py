"""The parameterised dashboard views on stand-ins for the dashboard's tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiolume.catalog.jobs_market import rent_table
from regiolume.catalog.jobs_people import pick, sql_list, wrap_sql
from regiolume.catalog.registry import YEARS_SQL, Tables, query
from regiolume.functions import numbers
from regiolume.operators import cube
from regiolume.operators.setops import stack
from regiolume.plans import views
from regiolume.session import stage


def digit(c: str, i: int = 1):
    """The leading digit of a priority as a number from 0."""
    return F.substring(c, i, 1).cast("int") - 1


def facts(t: Tables, variables: Sequence[str], *more) -> DataFrame:
    """Orders by month and priority: ``date``, ``variable`` and a count; the priority picks the variable."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    return t.orders.groupBy(
        month.alias("date"), pick(digit("o_orderpriority"), variables).alias("variable"), *more
    ).agg(F.count("*").cast("double").alias("estimate"))


def facts_sql(variables: Sequence[str], more: str = "") -> str:
    return f"""select date_trunc('month', o_orderdate)::date as date,
      {sql_list(variables)}[substr(o_orderpriority, 1, 1)::int] as variable{', ' + more if more else ''},
      count(*)::double as estimate from orders group by all"""


VEHICLES = ("Battery Electric Vehicle", "Hybrid Electric Vehicle", "Internal Combustion", "Total Vehicles", "Plug-in")
AREA_SQL = "case o_orderstatus when 'P' then 'King' else 'Region' end"


def area():
    return F.when(F.col("o_orderstatus") == "P", "King").otherwise("Region")


@query(
    "view_vehicles_by_type",
    f"""with f as ({facts_sql(VEHICLES, AREA_SQL + " as county, case o_orderstatus when 'F' then 'count' else 'share' end as metric")})
       select *, strftime(date, '%B-%Y') as year from f where county = 'Region' and metric = 'share'
         and variable not like '%Total%' and variable not like '%Internal%'""",
)
def view_vehicles_by_type(t: Tables):
    metric = F.when(F.col("o_orderstatus") == "F", "count").otherwise("share")
    return views.vehicles_by_type(facts(t, VEHICLES, area().alias("county"), metric.alias("metric")), "share")


@query(
    "view_new_registrations",
    f"""with f as ({facts_sql(VEHICLES, AREA_SQL + " as geography")})
       select date, variable, estimate as value, strftime(date, '%B-%Y') as year from f where geography = 'Region'""",
)
def view_new_registrations(t: Tables):
    rows = facts(t, VEHICLES, area().alias("geography")).withColumn("share", F.col("estimate") / 2)
    return views.new_registrations(rows, "estimate")


MAKES_SQL = """select year(o_orderdate)::int as year, o_orderstatus as variable,
  case o_custkey % 2 when 0 then 'Battery Electric Vehicle' else 'Hybrid Electric Vehicle' end as metric, count(*) as estimate
  from orders group by all"""


def makes(t: Tables) -> DataFrame:
    metric = F.when(F.col("o_custkey") % 2 == 0, VEHICLES[0]).otherwise(VEHICLES[1])
    return t.orders.groupBy(
        F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("variable"), metric.alias("metric")
    ).agg(F.count("*").alias("estimate"))


@query("view_makes_battery", f"select * from ({MAKES_SQL}) where metric = 'Battery Electric Vehicle' and year = 1999")
def view_makes_battery(t: Tables):
    return views.vehicle_makes(makes(t), 1999, "Battery Electric Vehicle")


@query("view_makes_hybrid", f"select * from ({MAKES_SQL}) where metric = 'Hybrid Electric Vehicle' and year = 2000")
def view_makes_hybrid(t: Tables):
    return views.vehicle_makes(makes(t), 2000, "Hybrid Electric Vehicle")


@query(
    "view_vehicle_miles",
    """select c_mktsegment as geography, count(*)::double as estimate, year(o_orderdate)::varchar as year
       from orders join customer on o_custkey = c_custkey where o_orderstatus = 'O' and o_orderpriority = '2-HIGH' group by 1, 3""",
)
def view_vehicle_miles(t: Tables):
    sales = t.orders.groupBy(
        "o_custkey", F.year("o_orderdate").alias("data_year"), F.col("o_orderpriority").alias("variable"),
        F.when(F.col("o_orderstatus") == "O", "Observed VMT").otherwise("Forecast VMT").alias("metric"),
    ).agg(F.count("*").alias("n"))
    rows = sales.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("c_mktsegment").alias("geography"), "data_year", "variable", "metric"
    ).agg(F.sum("n").cast("double").alias("estimate"))
    return views.vehicle_miles(rows, "2-HIGH")


GROUPS = (
    "American Indian or Alaskan Native Alone", "Asian alone", "Black or African American alone", "Two or more races", "White alone",
)
SHARE_VARIABLES = ("Worked from Home", "Transit", "Own")
SHARES_SQL = f"""select year(o_orderdate)::int as year, 'Region' as geography,
  {sql_list(GROUPS)}[substr(o_orderpriority, 1, 1)::int] as grouping, {sql_list(SHARE_VARIABLES)}[(o_custkey % 3 + 1)::int] as variable,
  count(*)::double as estimate, max(o_totalprice) as share from orders group by all"""


def shares(t: Tables) -> DataFrame:
    return t.orders.groupBy(
        F.year("o_orderdate").alias("year"), F.lit("Region").alias("geography"),
        pick(digit("o_orderpriority"), GROUPS).alias("grouping"), pick(F.col("o_custkey") % 3, SHARE_VARIABLES).alias("variable"),
    ).agg(F.count("*").cast("double").alias("estimate"), F.max("o_totalprice").alias("share"))


def shares_view_sql(year: int, variable: str, width: int, pattern: str) -> str:
    return f"""with f as ({SHARES_SQL}), g as (select * replace (regexp_replace(grouping, '{pattern}', '', 'g') as grouping)
                                             from f where year = {year} and variable = '{variable}')
       select *, {wrap_sql('grouping', width)} as race from g order by share"""


@query("view_work_from_home", shares_view_sql(1998, "Worked from Home", 20, " alone"))
def view_work_from_home(t: Tables):
    return views.work_from_home(shares(t), 1998)


@query("view_transit_commute", shares_view_sql(1999, "Transit", 20, " alone"))
def view_transit_commute(t: Tables):
    return views.transit_commute(shares(t), 1999)


@query("view_home_owners", shares_view_sql(2000, "Own", 25, " [aA]lone"))
def view_home_owners(t: Tables):
    return views.home_owners(shares(t), 2000)


COLLISION_GROUPS = ("County", "Race & Ethnicity", "Gender")
COLLISIONS_SQL = f"""select {sql_list(COLLISION_GROUPS)}[(o_custkey % 3 + 1)::int] as geography,
  case when o_custkey % 3 = 0 and o_orderstatus = 'F' then 'Region' else 'Some rather long group name ' || o_orderstatus end as name,
  year(o_orderdate)::int as year, case o_custkey % 2 when 0 then 'Traffic Related Deaths' else 'Serious Injuries' end as injury_type,
  count(*) as injuries, count(distinct o_custkey) as collisions, max(o_custkey % 100) / 8.0::double as injury_rate_per_100k,
  max(o_custkey % 50) / 4.0::double as collision_rate_per_100k from orders group by all"""


def collisions(t: Tables) -> DataFrame:
    key, status = F.col("o_custkey"), F.col("o_orderstatus")
    name = F.when((key % 3 == 0) & (status == "F"), "Region").otherwise(F.concat(F.lit("Some rather long group name "), status))
    raw = t.orders.groupBy(
        pick(key % 3, COLLISION_GROUPS).alias("geography"), name.alias("name"), F.year("o_orderdate").alias("year"),
        F.when(key % 2 == 0, "Fatality").otherwise("Serious Injury").alias("injury_type"),
    ).agg(
        F.count("*").alias("injuries"), F.countDistinct("o_custkey").alias("collisions"),
        (F.max(key % 100) / 8).alias("injury_rate_per_100k"), (F.max(key % 50) / 4).alias("collision_rate_per_100k"),
    )
    return views.clean_collisions(raw)


@query(
    "view_collisions_region",
    f"""select geography, name, year, injury_type, round_even(collision_rate_per_100k, 1) as metric, year::varchar as data_year
       from ({COLLISIONS_SQL}) where geography = 'County' and name = 'Region'""",
)
def view_collisions_region(t: Tables):
    return views.collisions_region(collisions(t), "collision_rate_per_100k")


@query(
    "view_fatality_by_group",
    f"""select geography, name, year, injury_type, round_even(injury_rate_per_100k, 1) as fatality_rate, {wrap_sql('name', 15)} as race
       from ({COLLISIONS_SQL}) where geography = 'Race & Ethnicity' and injury_type = 'Traffic Related Deaths' and year = 1999""",
)
def view_fatality_by_group(t: Tables):
    return views.fatality_by_group(collisions(t), 1999)


@query(
    "view_gender_fatal",
    f"""select geography, name, year, injury_type, injuries from ({COLLISIONS_SQL})
       where geography = 'Gender' and injury_type = 'Traffic Related Deaths' and year = 1999""",
)
def view_gender_fatal(t: Tables):
    return views.injuries_by_gender(collisions(t), 1999, "Traffic Related Deaths")


@query(
    "view_gender_serious",
    f"""select geography, name, year, injury_type, injuries from ({COLLISIONS_SQL})
       where geography = 'Gender' and injury_type = 'Serious Injuries' and year = 2000""",
)
def view_gender_serious(t: Tables):
    return views.injuries_by_gender(collisions(t), 2000, "Serious Injuries")


TRANSIT = ("Bus", "Ferry", "Total Transit", "Rail", "Vanpool")
CONCEPT_SQL = AREA_SQL + " as geography, case o_orderstatus when 'F' then 'Boardings' else 'Hours' end as concept"


def transit(t: Tables) -> DataFrame:
    concept = F.when(F.col("o_orderstatus") == "F", "Boardings").otherwise("Hours")
    return facts(t, TRANSIT, area().alias("geography"), concept.alias("concept"))


@query(
    "view_transit_by_month",
    f"""select *, strftime(date, '%b') as display_date, year(date)::varchar as year from ({facts_sql(TRANSIT, CONCEPT_SQL)})
       where geography = 'Region' and variable = 'Total Transit' and concept = 'Boardings' and year(date) >= 1998""",
)
def view_transit_by_month(t: Tables):
    return views.transit_by_month(transit(t), "Boardings", 1998)


@query(
    "view_transit_by_mode",
    f"""select year(date)::varchar as year, geography, concept, variable, sum(estimate) as estimate from ({facts_sql(TRANSIT, CONCEPT_SQL)})
       where geography = 'Region' and variable <> 'Total Transit' and concept = 'Hours' and year(date) >= 1998 group by 1, 2, 3, 4""",
)
def view_transit_by_mode(t: Tables):
    yearly = transit(t).groupBy(F.year("date").alias("year"), "geography", "concept", "variable").agg(
        F.sum("estimate").alias("estimate")
    )
    return views.transit_by_mode(yearly, "Hours", 1998)


AIRPORT = (*views.PASSENGERS, *views.FREIGHT, "Operations")


def airport(t: Tables) -> DataFrame:
    return facts(t, AIRPORT).withColumnRenamed("date", "data_day").withColumn("year", F.year("data_day"))


@query(
    "view_airport_by_month",
    f"""select variable, strftime(date, '%b') as display_date, estimate, year(date)::int as year from ({facts_sql(AIRPORT)})
       where variable = 'Operations'""",
)
def view_airport_by_month(t: Tables):
    return views.airport_by_month(airport(t), "Operations")


@query(
    "view_airport_passengers",
    f"""select year(date)::varchar as year, case when variable like '%Domestic%' then 'Domestic' else 'International' end as variable,
              sum(estimate) as passengers from ({facts_sql(AIRPORT)}) where variable like '%Passengers' group by 1, 2""",
)
def view_airport_passengers(t: Tables):
    return views.airport_passengers(airport(t))


@query(
    "view_airport_freight",
    f"""select year(date)::varchar as year, case when variable like '%Domestic%' then 'Domestic' else 'International' end as variable,
              sum(estimate) as cargo from ({facts_sql(AIRPORT)}) where variable like '%Freight' group by 1, 2""",
)
def view_airport_freight(t: Tables):
    return views.airport_freight(airport(t))


INDUSTRIES = ("Information", "Construction", "Total Nonfarm", "Government", "Manufacturing")
# The dashboard's years start in 2015: order years are moved by twenty.
JOBS_SQL = f"""select * replace ((date + interval 240 month)::date as date) from ({facts_sql(INDUSTRIES, AREA_SQL + ' as geography')})"""


def jobs(t: Tables) -> DataFrame:
    rows = facts(t, INDUSTRIES, area().alias("geography"))
    return rows.withColumn("date", F.date_format(F.add_months("date", 240), "yyyy-MM-dd"))


@query("view_jobs_total", f"select *, strftime(date, '%B-%Y') as year from ({JOBS_SQL}) where variable = 'Total Nonfarm'")
def view_jobs_total(t: Tables):
    return views.jobs_total(jobs(t))


@query("view_industries", f"select distinct variable from ({JOBS_SQL}) where geography = 'Region' and variable <> 'Total Nonfarm'")
def view_industries(t: Tables):
    return views.industries(jobs(t))


@query(
    "view_jobs_by_industry",
    f"select *, strftime(date, '%B-%Y') as year from ({JOBS_SQL}) where geography = 'Region' and variable = 'Construction'",
)
def view_jobs_by_industry(t: Tables):
    return views.jobs_by_industry(jobs(t), "Construction")


@query(
    "view_unemployment",
    """select ['King', 'Kitsap', 'Pierce', 'Snohomish'][(user_id % 5 + 1)::int] as geography, ts::date as date, count(*) as claims,
              strftime(ts::date, '%b-%-d-%Y') as year from events where user_id % 5 < 4 group by 1, 2""",
)
def view_unemployment(t: Tables):
    names = ("KING", "kitsap", "Pierce", "snohomish", "Skagit")
    rows = t.events.groupBy(
        pick(F.col("user_id") % 5, names).alias("geography"), F.date_format("ts", "M/d/yyyy").alias("date")
    ).agg(F.count("*").alias("claims"))
    return views.unemployment(rows)


@query(
    "view_home_sales",
    """select strftime(o_orderdate, '%B-%Y') as year, c_mktsegment as geography, count(*) as estimate
       from orders join customer on o_custkey = c_custkey group by 1, 2""",
)
def view_home_sales(t: Tables):
    sales = t.orders.groupBy("o_custkey", F.date_format("o_orderdate", "MMM-yy").alias("period")).agg(
        F.max("o_totalprice").alias("price"), F.count("*").alias("sales")
    )
    rows = sales.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("c_mktsegment").alias("region"), "period"
    ).agg(F.max("price").alias("price"), F.sum("sales").alias("sales"))
    return views.home_sales(rows, "sales")


@query(
    "view_rents",
    f"""with r as (select date_trunc('month', o_orderdate)::date as date, max(o_totalprice) as estimate
                  from orders join customer on o_custkey = c_custkey where c_nationkey = 7 group by 1),
            m as (select make_date(y, m, 1) as date from (select unnest({YEARS_SQL}) as y), (select unnest(range(1, 13)) as m))
       select 'Town 7' as geography, date, strftime(date, '%B-%Y') as year, round_even(estimate, 0) as estimate from m left join r using (date)""",
)
def view_rents(t: Tables):
    return views.rents(rent_table(t), "Town 7")


# One cube for several views ----------------------------------------------------------------------

CUBE_SETS = {"month": ("topic", "geography", "variable", "date"), "year": ("topic", "variable", "year")}


def cube_rows(t: Tables) -> DataFrame:
    """The facts behind vehicle, airport and job views in one long table."""
    parts = {"vehicles": VEHICLES, "airport": AIRPORT, "jobs": INDUSTRIES}
    rows = [facts(t, names, area().alias("geography")).withColumn("topic", F.lit(topic)) for topic, names in parts.items()]
    return stack(*rows).withColumn("year", F.year("date"))


CUBE_SQL = f"""
  with f as (select 'vehicles' as topic, * from ({facts_sql(VEHICLES, AREA_SQL + ' as geography')})
             union all select 'airport', * from ({facts_sql(AIRPORT, AREA_SQL + ' as geography')})
             union all select 'jobs', * from ({facts_sql(INDUSTRIES, AREA_SQL + ' as geography')}))"""


@query(
    "cube_views",
    f"""{CUBE_SQL}
  select 'vehicles' as view, strftime(date, '%Y-%m') as period, variable, estimate from f
         where topic = 'vehicles' and geography = 'Region' and variable not like '%Total%' and variable not like '%Internal%'
  union all select 'passengers', year(date)::varchar, variable, sum(estimate) from f where topic = 'airport' and variable like '%Passengers' group by 2, 3
  union all select 'freight', year(date)::varchar, variable, sum(estimate) from f where topic = 'airport' and variable like '%Freight' group by 2, 3
  union all select 'jobs', strftime(date, '%Y-%m'), variable, estimate from f where topic = 'jobs' and geography = 'Region' and variable = 'Construction'""",
)
def cube_views(t: Tables):
    """Four views as look-ups of one cube, which is written once."""
    made = stage(cube.build_cube(cube_rows(t), CUBE_SETS, "estimate"), "cube")
    month, year = F.date_format("date", "yyyy-MM").alias("period"), F.col("year").cast("string").alias("period")
    total = cube.strict_total().alias("estimate")

    def view(name: str, rows: DataFrame, period) -> DataFrame:
        return rows.select(F.lit(name).alias("view"), period, "variable", total)

    by_month = lambda topic, **more: cube.look_up(made, "month", ["variable", "date"], {"topic": topic, "geography": "Region"} | more)
    by_year = lambda names: cube.look_up(made, "year", ["variable", "year"], {"topic": "airport"}).filter(F.col("variable").isin(*names))
    types = ~F.col("variable").rlike("Total") & ~F.col("variable").rlike("Internal")
    return stack(
        view("vehicles", by_month("vehicles").filter(types), month), view("passengers", by_year(views.PASSENGERS), year),
        view("freight", by_year(views.FREIGHT), year), view("jobs", by_month("jobs", variable="Construction"), month),
    )


@query(
    "cube_merged",
    """select 'all' as set, null as o_orderpriority, null::int as yr, count(*) as n, max(o_totalprice) as most, sum(o_totalprice::decimal(18,2))::double as total, (sum(o_totalprice::decimal(18,2))::double / count(*)) as mean from orders
       union all select 'priority', o_orderpriority, null, count(*), max(o_totalprice), sum(o_totalprice::decimal(18,2))::double, (sum(o_totalprice::decimal(18,2))::double / count(*)) from orders group by 2
       union all select 'both', o_orderpriority, year(o_orderdate)::int, count(*), max(o_totalprice), sum(o_totalprice::decimal(18,2))::double, (sum(o_totalprice::decimal(18,2))::double / count(*)) from orders group by 2, 3""",
)
def cube_merged(t: Tables):
    """The orders of the last year are merged into the cube of the others, which is not computed again."""
    rows = t.orders.select("o_orderpriority", F.year("o_orderdate").alias("yr"), numbers.money("o_totalprice").alias("price"))
    sets = {"all": (), "priority": ("o_orderpriority",), "both": ("o_orderpriority", "yr")}
    old = stage(cube.build_cube(rows.filter("yr < 2001"), sets, "price"), "cube")
    both = cube.merge_cubes(old, cube.build_cube(rows.filter("yr >= 2001"), sets, "price"))
    return both.select(
        "set", "o_orderpriority", "yr", "n", F.col("most").cast("double").alias("most"), F.col("total").cast("double").alias("total"),
        cube.mean().alias("mean"),
    )
