"""Travel jobs: the benchmark tables are first brought into the published layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiolume.catalog.aggregates import NATION_SALES_SQL, as_double, nation_sales
from regiolume.catalog.registry import Tables, query
from regiolume.plans import charts, congestion, rules, travel

# Hour of the day -> column head of the segment table.
HOUR_HEADS = {h: ("Noon" if h == 12 else f"{h}am" if h < 12 else f"{h - 12}pm") for h in range(5, 21)}


def segments(t: Tables):
    """One row per road segment and year, one ratio column per hour, some ratios missing."""
    hour = F.hour("ts")
    year = (F.lit(2017) + F.floor((F.dayofmonth("ts") - 1) / 7)).cast("int")
    ratios = [F.min(F.when(hour == h, F.col("value") / 50)).alias(f"{head}_ratio") for h, head in HOUR_HEADS.items()]
    wide = t.events.groupBy("user_id", "event_type", year.alias("year")).agg(*ratios)
    return wide.withColumns({
        "Tmc": F.concat_ws("+", "user_id", "event_type"),
        "miles": (F.col("user_id") % 7 + 1).cast("double"),
        "thrulanes": (F.length("event_type") % 3 + 1).cast("double"),
    })


SEGMENTS_SQL = """
  s as (select user_id, event_type, (2017 + (day(ts) - 1) // 7)::int as year, hour(ts)::int as hour, min(value / 50) as ratio
        from events group by 1, 2, 3, 4),
  seg as (select distinct user_id, event_type, year, ((user_id % 7 + 1) * (length(event_type) % 3 + 1))::double as lane_miles from s),
  l as (select seg.year, h.hour, lane_miles, ratio from seg cross join (select unnest(range(5, 21))::int as hour) h
        left join s using (user_id, event_type, year, hour))"""


@query(
    "job_congestion",
    f"""with {SEGMENTS_SQL},
       b as (select year, hour, lane_miles, coalesce(ratio, 1) as r from l),
       g as (select year, hour, case when r <= 0.25 then 'Severe' when r <= 0.5 then 'Heavy'
                    when r <= 0.75 then 'Moderate' else 'Minimal' end as level, sum(lane_miles) as lane_miles
             from b group by 1, 2, 3),
       x as (select *, sum(lane_miles) over (partition by year, hour) as total_lane_miles from g)
       select year, hour, level, lane_miles, total_lane_miles, round_even(lane_miles / total_lane_miles, 2) as share from x""",
)
def job_congestion(t: Tables):
    return congestion.congestion_shares(segments(t), ratio_digits=None)


@query(
    "job_congestion_profile",
    f"""with {SEGMENTS_SQL},
       g as (select year, hour, sum(lane_miles) filter (ratio <= 0.5) as part, sum(lane_miles) as whole from l group by 1, 2)
       select year::varchar as year, lpad(hour::varchar, 2, '0') || ':00:00' as tod,
              case when hour < 12 then hour || 'AM' when hour = 12 then '12PM' else (hour - 12) || 'PM' end as hr,
              round_even(part / whole, 2) as share
       from g where part is not null and year >= 2019""",
)
def job_congestion_profile(t: Tables):
    """Two bands instead of four, shown over the day from one year on."""
    shares = congestion.congestion_shares(segments(t), by="heavy", ratio_digits=None)
    return congestion.severe_profile(shares, 2019, "Heavy Congestion")


@query(
    "threshold_share_by_hour",
    f"""with {SEGMENTS_SQL},
       y as (select year, sum(lane_miles) as total from seg group by 1),
       g as (select year, hour, coalesce(sum(lane_miles) filter (ratio <= 0.5), 0) as congested_miles
             from l where ratio is not null group by 1, 2)
       select year, hour, congested_miles, congested_miles / total as share from g join y using (year)""",
)
def threshold_share_by_hour(t: Tables):
    return congestion.heavy_share_by_hour(segments(t))


def daily_counts(t: Tables):
    """Daily table: a date text of one calendar year and one text column per year."""
    day = F.date_format("o_orderdate", "M/d")
    rows = t.orders.groupBy(day.alias("day")).agg(*[
        F.format_number(F.sum(F.when(F.year("o_orderdate") == y, F.col("o_custkey") + 1)), 0)
        .alias(f"{y} Traveler Throughput") for y in reversed(t.years())
    ])
    return rows.filter(F.col("day") != "2/29").withColumn("Date", F.concat(F.col("day"), F.lit("/2021"))).drop("day")


def weekly_counts(t: Tables):
    """Weekly table: ``Week 12`` and one text column per year."""
    week = (F.floor((F.dayofyear("o_orderdate") - 1) / 7) + 1).cast("int")
    return t.orders.groupBy(
        F.concat(F.lit("Week "), week).alias("Week")
    ).agg(*[
        F.format_number(F.sum(F.when(F.year("o_orderdate") == y, F.col("o_custkey") + 1)), 0).alias(str(y))
        for y in reversed(t.years())
    ])


DAILY_SQL = """
  d as (select strftime(o_orderdate, '%m-%d') as md, year(o_orderdate) as y, sum(o_custkey + 1) as v from orders
        where strftime(o_orderdate, '%m-%d') <> '02-29' group by 1, 2),
  grid as (select md, y, v from (select distinct md from d) cross join (select distinct y from d)
           left join d using (md, y)),
  w as (select y::varchar as year, ((dayofyear(('2021-' || md)::date) - 1) // 7 + 1)::int as week,
               case when count(v) = count(*) then median(v)::double end as passenger_screenings from grid group by 1, 2),
  a as (select distinct ((dayofyear(o_orderdate) - 1) // 7 + 1)::int as week from orders)"""


@query(
    "job_weekly_median",
    f"""with {DAILY_SQL}
       select year, week, passenger_screenings,
              case when a.week is not null then (date '2021-01-01' + ((w.week - 1) * 7)::int)::date end as day
       from w left join a using (week)""",
)
def job_weekly_median(t: Tables):
    return travel.weekly_median_with_day(daily_counts(t), travel.weekly_screenings(weekly_counts(t)))


# Fixed values of the stand-in: priority -> transit mode, nation -> agency name.
MODE_OF = {"1-URGENT": "MB", "2-HIGH": "FB", "3-MEDIUM": "LR", "4-NOT SPECIFIED": "CR", "5-LOW": "DR"}
AGENCY_OF = {1: "City of Everett", 3: "King County Ferry District", 5: "King County Department of Metro Transit"}


def month_heads(t: Tables) -> list[str]:
    names = ("JAN", "APR", "JUL", "OCT")
    return [f"{m}{y % 100:02d}" for y in t.years() for m in names]


def transit_table(t: Tables):
    """Boardings with one column per month, as published; every third month is given."""
    mode = F.lit(None).cast("string")
    for priority, code in MODE_OF.items():
        mode = F.when(F.col("o_orderpriority") == priority, code).otherwise(mode)
    sales = t.orders.groupBy(
        "o_custkey", mode.alias("Modes"), F.upper(F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "quarter"), "MMMyy")).alias("head")
    ).agg(F.count("*").alias("n"))
    placed = sales.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    agency = F.concat(F.lit("Agency "), F.col("c_nationkey"))
    for key, name in AGENCY_OF.items():
        agency = F.when(F.col("c_nationkey") == key, name).otherwise(agency)
    wide = placed.groupBy("c_nationkey", "Modes").pivot("head", month_heads(t)).agg(F.sum("n"))
    return wide.select(
        F.col("c_nationkey").cast("string").alias("4.digit.NTD.ID"), F.lit("0").alias("5.digit.NTD.ID"),
        agency.alias("Agency"), F.lit("Active").alias("Active"), F.lit("Full").alias("Reporter.Type"),
        F.lit(14).alias("UZA"), F.lit("Area").alias("UZA.Name"), "Modes", F.lit("DO").alias("TOS"), *month_heads(t),
    )


TRANSIT_SQL = """
  m as (select case c_nationkey when 1 then 'Everett Transit' when 3 then 'King County Metro' when 5 then 'King County Metro'
                    else 'Agency ' || c_nationkey end as agency,
               case o_orderpriority when '1-URGENT' then 'Bus' when '2-HIGH' then 'Ferry'
                    when '3-MEDIUM' then 'Light Rail, Streetcar & Monorail' when '4-NOT SPECIFIED' then 'Commuter Rail' end as mode,
               date_trunc('quarter', o_orderdate)::date as month, count(*)::double as estimate
        from orders join customer on o_custkey = c_custkey
        where c_nationkey in (1, 3, 5, 20, 23) and o_orderpriority <> '5-LOW' group by 1, 2, 3)"""


@query(
    "job_transit_ytd",
    f"""with {TRANSIT_SQL}
       select agency, year(month)::int as year, mode, sum(estimate) as estimate from m
       where month(month) <= (select month(max(month)) from m) and year(month) between 1996 and 2000 group by 1, 2, 3""",
)
def job_transit_ytd(t: Tables):
    return travel.transit_ytd(travel.transit_months(transit_table(t)), 1996, 2000)


@query(
    "job_transit_year_ratio",
    f"""with {TRANSIT_SQL}, y as (select year(month) as year, sum(estimate) as v from m
                                  where month(month) <= (select month(max(month)) from m) group by 1)
       select max(v) filter (year = 2000) / max(v) filter (year = 1996) as ratio from y""",
)
def job_transit_year_ratio(t: Tables):
    totals = travel.transit_ytd(travel.transit_months(transit_table(t)), t.years().start)
    return travel.year_ratio(totals, 2000, 1996)


@query(
    "job_transit_months",
    f"""with {TRANSIT_SQL}
       select month, sum(estimate) as estimate, year(month)::varchar as year, make_date(2021, month(month), day(month)) as day
       from m where year(month) >= 1997 group by month""",
)
def job_transit_months(t: Tables):
    return travel.transit_overlay(travel.transit_months(transit_table(t)), 1997)


# Fixed values of the stand-in: event type -> count station.
STATIONS = {
    "click": "I-5 at Mile 1", "view": "I-405 at Mile 2", "purchase": "I-90 at Bridge", "signup": "SR 167 at Valley",
    "error": "US 2 at Pass",
}
STATION_SQL = "case event_type " + " ".join(f"when '{k}' then '{v}'" for k, v in STATIONS.items()) + " end"
COUNTY_SQL = "['King', 'Kitsap', 'Pierce', 'Snohomish', 'Skagit'][(user_id % 5 + 1)::int]"


def station_table(t: Tables):
    """Count stations with the date hidden at the end of a longer text."""
    place = F.lit(None).cast("string")
    for kind, name in STATIONS.items():
        place = F.when(F.col("event_type") == kind, name).otherwise(place)
    county = F.element_at(
        F.array(*[F.lit(c) for c in (*rules.COUNTIES, "Skagit")]), (F.col("user_id") % 5 + 1).cast("int")
    )
    return t.events.select(
        F.split("event_type", "e").getItem(0).alias("Highway"), county.alias("County"), place.alias("Location"),
        F.date_format("ts", "EEE MM/dd/yy").alias("Date"), F.lit("").alias("Previous_Date"),
        F.when(F.col("event_id") % 4 == 0, "Previous").otherwise("Current").alias("Measure"),
        F.date_format("ts", "EEEE").alias("Day_of_Week"),
        (F.col("event_id") % 1000).alias("Current_Volume"), (F.col("user_id") + 500).alias("Baseline_Volume"),
        F.concat((F.col("event_id") % 30 - 15).cast("string"), F.lit("%")).alias("Ratio"),
    )


@query(
    "job_volume_ratio",
    f"""with v as (select {STATION_SQL} as location, event_id % 1000 as cur, user_id + 500 as base from events
                  where event_id % 4 <> 0 and user_id % 5 <> 4),
       g as (select 'All highways' as corridor, * from v
             union all select 'I-5 and I-405', * from v where regexp_matches(location, 'I-5|I-405')
             union all select 'Cross-lake', * from v where regexp_matches(location, 'I-90|SR 520')
             union all select 'Other state routes', * from v where regexp_matches(location, 'SR 167|SR 410|SR 512'))
       select corridor, sum(cur)::double as current, sum(base)::double as baseline, sum(cur)::double / sum(base)::double as ratio
       from g group by 1""",
)
def job_volume_ratio(t: Tables):
    return travel.corridor_ratios(travel.highway_volumes(station_table(t), year=2024))


@query(
    "job_truck_volumes",
    f"""select {STATION_SQL} as location, ts::date as date, (event_id % 30 - 15)::double / 100 + 1 as ratio from events
       where user_id % 5 <> 4 and regexp_matches({STATION_SQL}, 'SR 16|SR 167|SR 410|SR 512')""",
)
def job_truck_volumes(t: Tables):
    trucks = travel.truck_volumes(station_table(t), year=2024)
    return travel.corridor_series(trucks, rules.TRUCK_CORRIDORS["Other state routes"])


@query(
    "job_volume_index",
    f"""select {STATION_SQL} as location, ts::date as date, (event_id % 1000)::double / (user_id + 500) as ratio from events
       where event_id % 4 <> 0 and user_id % 5 <> 4
         and (event_id % 1000)::double / (user_id + 500) between 0.1 and 2""",
)
def job_volume_index(t: Tables):
    return travel.clipped_index(travel.highway_volumes(station_table(t), year=2024))


@query(
    "job_location_volumes",
    f"""select string_split(event_type, 'e')[1] as highway, {COUNTY_SQL} as county, {STATION_SQL} as location, ts::date as date,
              (event_id % 1000)::double as current, (user_id + 500)::double as baseline, (event_id % 1000)::double / (user_id + 500) as ratio
       from events where event_id % 4 <> 0 and user_id % 5 <> 4""",
)
def job_location_volumes(t: Tables):
    """The layout with named columns and the date inside a longer text."""
    named = station_table(t).select(
        F.col("Highway").alias("Highway1"), F.col("County").alias("Counties"), F.col("Location").alias("Traffic Count Locations"),
        F.regexp_replace("Date", "^(...) ", "$1, ").alias("Day of 2020Date"), F.col("Measure").alias("Measure Names"),
        F.col("Current_Volume").alias("Measure Values"), F.col("Baseline_Volume").alias("2019 Volume"),
    )
    return travel.location_volumes(named)


def ferry_table(t: Tables):
    routes = F.array(*[F.lit(r) for r in (*rules.FERRY_ROUTES, "Somewhere else")])
    measure = F.element_at(
        F.array(*[F.lit(m) for m in (rules.FERRY_BASE, rules.FERRY_CURRENT, rules.FERRY_CHANGE)]),
        (F.col("event_id") % 3 + 1).cast("int"),
    )
    return t.events.select(
        F.date_format("ts", "M/d/yyyy").alias("Date"), F.lit("").alias("Previous_Date"),
        F.element_at(routes, (F.col("user_id") % 8 + 1).cast("int")).alias("Route"), measure.alias("Measure"),
        F.lit(0).alias("Old"),
        F.when(F.col("event_id") % 3 == 2, (F.col("event_id") % 8 - 4) / 8).otherwise(F.col("event_id") % 500).alias("Ratio"),
    )


@query(
    "job_ferry_ratio",
    """with f as (select event_id % 3 as m, (event_id % 500)::double as v from events where user_id % 8 < 7)
       select sum(v) filter (m = 1) as current, sum(v) filter (m = 0) as baseline,
              sum(v) filter (m = 1) / sum(v) filter (m = 0) as ratio from f""",
)
def job_ferry_ratio(t: Tables):
    return travel.ferry_ratio(ferry_table(t), year=2024)


@query(
    "job_ferry_series",
    """select ['Edmonds -  Kingston', 'Fauntleroy - Vashon - Southworth', 'Mukilteo - Clinton',
               'Point Defiance - Tahlequah', 'Port Townsend - Coupeville', 'Seattle - Bainbridge Island',
               'Seattle - Bremerton'][(user_id % 8 + 1)::int] as route, ts::date as date,
              (event_id % 8 - 4) / 8.0::double + 1 as ratio
       from events where user_id % 8 < 7 and event_id % 3 = 2""",
)
def job_ferry_series(t: Tables):
    return travel.ferry_series(ferry_table(t), year=2024)


@query(
    "chart_dataset",
    f"""with s as (select r_name, yr, sum(estimate)::double as estimate from ({NATION_SALES_SQL}) group by 1, 2)
       select yr as x, estimate as y, r_name as group, yr::varchar as facet,
              r_name || ': $' || format('{{:,}}', round_even(estimate, -3)::bigint) || ' total' as label,
              nullif(list_position(['ASIA', 'EUROPE', 'AFRICA'], r_name), 0)::int as place from s""",
)
def chart_dataset(t: Tables):
    rows = nation_sales(t).groupBy("r_name", "yr").agg(F.sum("estimate").alias("estimate"))
    return charts.chart_dataset(
        as_double(rows, "estimate"), "yr", "estimate", "r_name", "yr", -3, prefix="$", suffix=" total",
        levels=["ASIA", "EUROPE", "AFRICA"],
    )
